"""Collection files: one per collection, compressed where they are read again by Spark."""

from pathlib import Path

from pyspark.sql import functions as F

from bibweave.operators.ordered import by_width
from bibweave.sources import xml
from bibweave.sources.collections import collections, write_collections


def test_compressed_collections_hold_every_record_in_less_room(spark, tmp_path):
    doc = F.format_string("<mods><titleInfo><title>Title %d</title></titleInfo><note>%s</note></mods>", "id", F.repeat(F.lit("as before "), 20))
    parts = collections(spark.range(1030).select("id", doc.alias("mods")), "id", by_width("id", 100), 100)
    sizes = {}
    for how in ("none", "gzip"):
        folder = write_collections(parts, f"{tmp_path}/{how}", compression=how)
        files = list(Path(folder).glob("collection=*/part-*"))
        assert len(files) == 11 and len({f.parent for f in files}) == 11
        rows = xml.read_collection(spark, folder, "titleInfo array<struct<title:string>>").select(F.get("titleInfo", 0)["title"]).collect()
        assert sorted(r[0] for r in rows) == sorted(f"Title {i}" for i in range(1030))
        sizes[how] = sum(f.stat().st_size for f in files)
    assert sizes["gzip"] * 5 < sizes["none"]
