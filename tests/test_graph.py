"""Files of the graph import: compressed, each distinct author once."""

import glob

from bibweave.session import run_dir
from bibweave.sources import graph


def test_extract_is_compressed_and_complete(spark):
    pubs = spark.createDataFrame([(1, "x"), (2, None)], "PID long, Title string")
    rows = [(1, "s1", "A, B"), (1, "s1", "A, B"), (1, None, 'say "a"'), (2, None, "two\nlines"), (None, None, None)]
    folder = run_dir(spark, "graph")
    headers = graph.bulk_extract(pubs, spark.createDataFrame(rows, "PID long, staffid string, name string"), folder)
    for name in ("pubs", "authors", "rels"):
        files = [f for f in glob.glob(f"{folder}/{name}/*") if "_SUCCESS" not in f]
        assert files and all(f.endswith(".csv.gz") for f in files)
    assert headers["authors"] == "mid:ID,PID,staffid,name,label:LABEL"
    people = [tuple(r) for r in spark.read.csv(f"{folder}/authors", escape='"', multiLine=True).collect()]
    distinct = {(str(p) if p else None, s, n) for p, s, n in rows}
    assert len(people) == 4 and {r[1:4] for r in people} == distinct and len({r[0] for r in people}) == 4
    links = [tuple(r) for r in spark.read.csv(f"{folder}/rels", escape='"', multiLine=True).collect()]
    assert {(r[1], r[0]) for r in links} == {(r[0], r[1]) for r in people}
