"""Linking records of two sources by title distance or by identifier.

A fuzzy join compares only rows that share a key no true pair can miss. For a
distance of at most ``k`` edits (adjacent transpositions included) a text is
cut into ``k + 1`` segments with one free character between neighbours. An edit
touches at most one segment, so one of them survives and occurs in the other
text, shifted by the insertions and deletions before it. Those, together with
the ones after it, number at most ``k``, which bounds the shifts to try.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.distance import jaro_similarity, jaro_winkler_similarity, levenshtein_similarity, osa_distance
from bibweave.functions.nulls import nullsafe_join
from bibweave.operators.groups import counts, first_row
from bibweave.operators.setops import stack
from bibweave.session import cut_lineage, spread

c = F.col
HOT_PAIRS = 1_000_000


def _segment(n: Column, i: Column, k: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` of a text of length ``n``."""
    room = n - k
    base = F.floor(room / (k + 1)).cast("int")
    extra = (room % (k + 1)).cast("int")
    return i * (base + 1) + F.least(i, extra) + 1, base + (i < extra).cast("int")


def _key(n: Column, i: Column, text: Column) -> Column:
    """Join key of a segment. A chance collision only adds a pair to test."""
    return F.xxhash64(n, i, text)


def _indexed_keys(title: str, k: int) -> Column:
    """Segment keys of the indexed side; short texts are keyed by length only."""
    n = F.length(title)

    def key(i: Column) -> Column:
        start, size = _segment(n, i, k)
        return _key(n, i, F.substr(c(title), start, size))

    cut = F.transform(F.sequence(F.lit(0), F.lit(k)), key)
    return F.when(n > 2 * k, cut).otherwise(F.array(_key(n, F.lit(-1), F.lit(""))))


def _probed(texts: DataFrame, title: str, k: int) -> DataFrame:
    """Rows with every key under which a partner within ``k`` edits may be indexed.

    The steps are exploded as rows, so the keys are plain compiled expressions.
    A repeated key only repeats a pair, which is removed at the end."""
    steps = [
        (i, longer, shift)
        for longer in range(-k, k + 1)
        for shift in range(-k, k + 1)
        if abs(shift) + abs(longer - shift) <= k
        for i in range(k + 1)
    ]
    steps += [(-1, longer, 0) for longer in range(-k, k + 1)]
    listed = ", ".join(f"named_struct('i', {i}, 'm', {m}, 't', {t})" for i, m, t in steps)
    rows = texts.withColumn("__p", F.explode(F.expr(f"array({listed})")))
    size = F.length(title)
    i, n = c("__p.i"), size - c("__p.m")
    start, width = _segment(n, i, k)
    at = start + c("__p.t")
    whole = F.when((n >= 0) & (n <= 2 * k), _key(n, i, F.lit("")))
    fits = (n > 2 * k) & (at >= 1) & (at + width - 1 <= size)
    cut = F.when(fits, _key(n, i, F.substr(c(title), at, width)))
    return rows.withColumn("key", F.when(i < 0, whole).otherwise(cut)).drop("__p")


def _profile(title: str) -> list[Column]:
    """Letter-class counts: an edit changes each by at most one."""
    t = c(title)
    return [
        F.regexp_count(t, F.lit("[aeiouy0-4]")),
        F.regexp_count(t, F.lit("[b-df-hj-km5-9]")),
    ]


# 32 classes of characters whose counts are compared; what is in none of them is not counted.
CLASSES = [f"{x}{x.upper()}{dict(j='3', q='0', x='1', z='2').get(x, '')}" for x in "abcdefghijklmnopqrstuvwxyz"] + list("456789")


def _signature(title: str) -> Column:
    """Counts of 32 classes of characters, modulo four, two bits of Gray code each.

    A count that changes by one changes one bit, and an edit changes at most
    two counts by one, so texts within k edits differ in at most 2 * k bits."""
    bits = F.lit(0).cast("long")
    for i, chars in enumerate(CLASSES):
        n = F.regexp_count(c(title), F.lit(f"[{chars}]")) % 4
        bits = bits.bitwiseOR(F.shiftleft(n.bitwiseXOR(F.shiftright(n, 1)).cast("long"), 2 * i))
    return bits


def fuzzy_pairs(left: DataFrame, right: DataFrame, title: str, k: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(left_title, right_title, osa_dist) of distinct titles at most ``k`` apart.

    Keys that would compare more than ``hot_pairs`` pairs are divided further
    by letter-class counts, the probing side trying every count within ``k``;
    this splits the group and loses no pair. The distance test is part of the
    join, so only near pairs leave it; signatures spare most pairs the test.

    A probing title has many keys and an indexed one few, so the side with
    fewer titles probes; the distance is the same both ways. Keys are many
    times the titles they come from, which Spark's size estimates do not show:
    their joins are merge joins, as a broadcast would pass them through the driver.
    """
    titles = [t.where(c(title).isNotNull()).select(c(title).alias("t")).distinct() for t in (left, right)]
    sides = [cut_lineage(spread(t, "t").withColumn("s", _signature("t")), "titles") for t in titles]
    turned = sides[1].count() < sides[0].count()
    few, many = reversed(sides) if turned else sides
    a, b = spread(few.toDF("a", "sa"), "a"), spread(many.toDF("b", "sb"), "b")
    probe = _probed(a, "a", k)
    index = b.withColumn("key", F.explode(_indexed_keys("b", k)))
    keys = ["key"]
    size_a, size_b = counts(probe, keys, "na"), counts(index, keys, "nb")
    large = size_a.join(size_b.hint("merge"), keys).where(c("na") * c("nb") > hot_pairs)
    hot = cut_lineage(large.select(*keys, F.lit(True).alias("hot")), "hot")
    pa, qa = _profile("a")
    pb, qb = _profile("b")
    offsets = ", ".join(
        f"named_struct('x', {x}, 'y', {y})" for x in range(-k, k + 1) for y in range(-k, k + 1) if abs(x) + abs(y) <= 2 * k
    )
    near = F.transform(F.expr(f"array({offsets})"), lambda o: F.struct((pa + o["x"]).alias("p"), (qa + o["y"]).alias("q")))
    none = F.array(F.struct(F.lit(-1).alias("p"), F.lit(-1).alias("q")))
    own = F.array(F.struct(pb.alias("p"), qb.alias("q")))
    split = lambda t, mine: (
        t.join(hot, keys, "left").withColumn("x", F.explode(F.when(c("hot"), mine).otherwise(none)))
        .withColumns({"p": c("x.p"), "q": c("x.q")}).drop("x", "hot")
    )
    close = (F.bit_count(c("sa").bitwiseXOR(c("sb"))) <= 2 * k) & (F.levenshtein("a", "b", 2 * k) >= 0)
    if hot.isEmpty():
        met = probe.join(index.hint("merge"), keys)
    else:
        met = split(probe, near).join(split(index, own).hint("merge"), [*keys, "p", "q"])
    pairs = met.where(close).select("a", "b")
    # scored before the repetitions are removed: they are few, and the filter
    # would otherwise be pushed down and make the function run twice
    scored = pairs.withColumn("osa_dist", osa_distance(c("a"), c("b"))).where(c("osa_dist") <= k)
    here, there = ("b", "a") if turned else ("a", "b")
    return cut_lineage(scored.select(c(here).alias("left_title"), c(there).alias("right_title"), "osa_dist").distinct(), "near-titles")


def title_links(
    left: DataFrame, right: DataFrame, title: str = "title", id_col: str = "id", k: int = 3, first: bool = True
) -> DataFrame:
    """Rows linked by titles within ``k`` edits, with scores: the first row of every title on both sides, or every row."""
    titled = lambda t: t.where(c(title).isNotNull())
    one = lambda t: first_row(titled(t), [title], [c(id_col)]) if first else titled(t)
    a = one(left).select(c(id_col).alias("from_id"), c(title).alias("left_title"))
    b = one(right).select(c(id_col).alias("to_id"), c(title).alias("right_title"))
    pairs = fuzzy_pairs(a.select(c("left_title").alias("t")), b.select(c("right_title").alias("t")), "t", k)
    linked = pairs.join(a.hint("merge"), "left_title").join(b.hint("merge"), "right_title")
    return linked.withColumns(
        {
            "levenshtein_score": levenshtein_similarity(c("left_title"), c("right_title")),
            "jarowinkler_score": jaro_winkler_similarity(c("left_title"), c("right_title")),
        }
    )


def exact_links(left: DataFrame, right: DataFrame, number: str = "number", id_col: str = "id") -> DataFrame:
    """Links by equal cleaned number, strength 1."""
    a = left.where(c(number).isNotNull()).select(number, c(id_col).alias("from_id"))
    b = right.where(c(number).isNotNull()).select(number, c(id_col).alias("to_id"), c("title").alias("right_title"))
    return a.join(b.hint("merge"), number).select("from_id", "to_id", "right_title", F.lit(1.0).alias("strength"))


def link_table(
    fuzzy: DataFrame, exact: DataFrame, source: str, target: str, as_of: dt.date, parity: bool = False
) -> DataFrame:
    """Combined links, the first per target title, in the link layout.

    ``parity`` drops the exact links, as the established run does because they
    carry no score."""
    near = fuzzy.select("from_id", "to_id", "right_title", c("levenshtein_score").alias("strength"), F.lit(0).alias("__o"))
    sure = exact.select("from_id", "to_id", "right_title", "strength", F.lit(1).alias("__o"))
    order = [c("__o"), c("strength").desc(), c("from_id"), c("to_id")]
    once = first_row(near.unionByName(sure), ["right_title"], order)
    return _linked(once.where((c("strength") != 0) & (c("__o") == 0 if parity else F.lit(True))), source, target, as_of)


def master_links(*tables: DataFrame) -> DataFrame:
    return stack(*tables)


@dataclass(frozen=True)
class SourcePair:
    """How two sources are linked: by titles within ``edits``, by ``number``, or both; ``first`` takes the first row of a title."""

    source: str
    target: str
    edits: int | None = None
    number: bool = False
    first: bool = False
    master: bool = True


# The pairs of project sources, and which of them stay out of the master table.
SOURCE_PAIRS = [
    SourcePair("case", "swecris", 3, number=True, first=True),
    SourcePair("case", "cordis", 3, first=True, master=False),
    SourcePair("case", "openaire", 3, first=True),
    SourcePair("case", "vinnova", 3, first=True),
    SourcePair("case", "formas", 3, first=True),
    SourcePair("swecris", "vinnova", number=True),
    SourcePair("swecris", "formas", number=True),
    SourcePair("swecris", "cordis", 3),
    SourcePair("swecris", "openaire", 4),
    SourcePair("cordis", "openaire", 2),
]


def source_links(sources: dict[str, DataFrame], pair: SourcePair, as_of: dt.date) -> DataFrame:
    """The link table of one pair; a source has id, title and number."""
    a, b = sources[pair.source], sources[pair.target]
    exact = exact_links(a, b)
    if pair.edits is None:
        return _linked(exact, pair.source, pair.target, as_of)
    fuzzy = title_links(a, b, k=pair.edits, first=pair.first)
    if pair.first:
        return link_table(fuzzy, exact if pair.number else exact.limit(0), pair.source, pair.target, as_of)
    return _linked(fuzzy.withColumn("strength", c("levenshtein_score")), pair.source, pair.target, as_of)


def linked_sources(sources: dict[str, DataFrame], as_of: dt.date, pairs: list[SourcePair] = SOURCE_PAIRS, master: bool = True) -> DataFrame:
    """The link tables of all pairs of sources that are given, or (``master``) of those that make up the master table."""
    wanted = [p for p in pairs if {p.source, p.target} <= set(sources) and (p.master or not master)]
    return master_links(*[source_links(sources, p, as_of) for p in wanted])


def _linked(rows: DataFrame, source: str, target: str, as_of: dt.date) -> DataFrame:
    return rows.select(
        F.lit(source).alias("from"), c("from_id").cast("string").alias("from_id"), F.lit(target).alias("to"),
        c("to_id").cast("string").alias("to_id"), "strength", F.lit(None).cast("boolean").alias("curated"),
        F.lit(as_of).alias("date"),
    )


# Letters from rare to common, for the order of match tokens.
RARE_FIRST = "ZQJXKVBWPYGFMUCLDRHSNIOTAE "


def _tokens(text: Column) -> Column:
    """Characters numbered by occurrence, rare ones first. Two texts share as
    many tokens as they have characters in common."""
    letters = F.split(text, "")
    numbered = F.transform(
        letters,
        lambda x, i: F.struct(
            (-F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda y: y == x))).alias("o"),
            F.instr(F.lit(RARE_FIRST), x).alias("r"),
            x.alias("ch"),
        ),
    )
    return F.transform(F.array_sort(numbered), lambda x: F.concat(x["ch"], x["o"].cast("string")))


def best_matches(left: DataFrame, right: DataFrame, name: str, max_distance: float = 0.1) -> DataFrame:
    """(name, match, distance): the nearest right name within a Jaro distance.

    From a similarity of ``1 - max_distance`` on, both texts share at least a
    known number of characters. Each side is therefore indexed by its first (rarest) tokens
    only, as many as must contain a shared one, and compared when the lengths
    and the shared characters allow it.
    """
    share = 3 * (1 - max_distance) - 1  # m/|a| + m/|b| is at least this much
    a = spread(left.where(F.length(name) > 0).select(c(name).alias("a")).distinct(), "a").withColumn("ua", F.upper("a"))
    b = spread(right.where(F.length(name) > 0).select(c(name).alias("b")).distinct(), "b").withColumn("ub", F.upper("b"))

    def prefixed(t: DataFrame, text: str, tokens: str) -> DataFrame:
        n = F.length(text)
        # fewest characters to share: the partner is at its shortest, n * (share - 1)
        least = F.ceil(F.lit(share) * n * (n * (share - 1)) / (n + n * (share - 1)) - 1e-9)
        head = F.slice(c(tokens), F.lit(1), F.greatest((n - least + 1).cast("int"), F.lit(1)))
        return t.withColumn(tokens, _tokens(c(text))).withColumn("token", F.explode(head))

    la, lb = F.length("ua"), F.length("ub")
    common = F.array_intersect("ta", "tb")
    # part of the join: enough shared characters, and each pair at its first
    # shared token only, so no pair is made twice and no far pair is made at all
    fits = (F.size(common) * (1 / la + 1 / lb) >= share - 1e-9) & (F.get(common, 0) == c("token"))
    pairs = prefixed(a, "ua", "ta").join(prefixed(b, "ub", "tb"), "token").where(fits).select("a", "ua", "b", "ub")
    near = pairs.withColumn("distance", 1 - jaro_similarity(c("ua"), c("ub"))).where(
        c("distance") <= max_distance + 1e-12
    )
    best = near.groupBy("a").agg(F.min_by(F.struct("b", "distance"), F.struct("distance", "b")).alias("x"))
    return best.select(c("a").alias(name), c("x.b").alias("match"), c("x.distance").alias("distance"))


def match_units(units: DataFrame, english: DataFrame, swedish: DataFrame, max_distance: float = 0.1) -> DataFrame:
    """Slug of every unit by its English name, else by its Swedish one.

    Both lookups have (name, slug)."""

    def slug(column: str, table: DataFrame, out: str) -> DataFrame:
        best = best_matches(units.select(c(column).alias("name")), table, "name", max_distance)
        named = table.groupBy(c("name").alias("match")).agg(F.min("slug").alias(out))
        return best.join(named, "match").select(c("name").alias(column), out)

    out = nullsafe_join(units, slug("unit_en", english, "__en"), ["unit_en"], "left")
    out = nullsafe_join(out, slug("unit_sv", swedish, "__sv"), ["unit_sv"], "left")
    return out.withColumn("slug", F.coalesce("__en", "__sv")).drop("__en", "__sv")
