"""Runs of the check catalogue: fused row checks, tables and statistics."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.links import linkify
from bibweave.operators.checks import CHECKS, Check, prefilter, within_prefilter
from bibweave.operators.setops import in_report_order

# The checks of the standard run and of the run for another institution.
STANDARD = [
    "article_title_multiplettes", "title_multiplettes", "submission_status_invalid", "missing_staffid",
    "missing_orcids", "missing_confpubdate", "missing_journal_ids", "odd_book_chapters", "invalid_ISI",
    "invalid_DOI", "invalid_ISSN", "invalid_staffid", "invalid_orcid", "invalid_scopusid", "invalid_isbn",
    "invalid_use_isbn", "invalid_authorname", "uncertain_published", "multiplettes_scopusid", "multiplettes_DOI",
    "multiplettes_ISI", "manuscripts_with_identifiers", "non_qc", "non_qc_stale",
]
OTHER = [
    "title_multiplettes", "submission_status_invalid", "missing_aid", "missing_confpubdate", "missing_journal_ids",
    "odd_book_chapters", "invalid_ISI", "invalid_DOI", "invalid_ISSN", "invalid_aid", "invalid_orcid",
    "invalid_isbn", "invalid_authorname", "multiplettes_scopusid", "multiplettes_DOI", "multiplettes_ISI",
]
UNFILTERED = {"non_qc", "non_qc_stale"}


class CheckRun:
    """One run over one corpus; every table is lazy.

    ``pubs`` may be persisted by the caller: all checks read the same columns.
    """

    def __init__(
        self, pubs: DataFrame, authors: DataFrame, as_of: dt.date, stop_list: DataFrame | None = None,
        names: list[str] | None = None, filtered: bool = True, external: DataFrame | None = None,
        since: dt.date = dt.date(2023, 1, 1),
    ):
        self.all_pubs, self.authors, self.as_of, self.stop_list = pubs, authors, as_of, stop_list
        self.pubs = prefilter(pubs, as_of) if filtered else pubs
        self.names = list(names or STANDARD)
        self.external, self.since, self.filtered = external, since, filtered

    def _inputs(self, name: str) -> list:
        given = {
            "pubs": self.all_pubs if name in UNFILTERED else self.pubs,
            "authors": self.authors,
            "as_of": self.as_of,
            "since": self.since,
            "stop_list": self.stop_list,
            "expand_against": self.all_pubs,
        }
        return [given[n] for n in CHECKS[name].needs]

    def table(self, name: str) -> DataFrame:
        """The offending rows of one check."""
        return CHECKS[name].run(*self._inputs(name))

    def tables(self) -> dict[str, DataFrame]:
        out = {n: self.table(n) for n in self.names}
        if self.external is not None:
            out["external"] = self.external
        return out

    def report(self, name: str, portal: str = "") -> DataFrame:
        """The table as a report shows it: sorted, identifiers linked."""
        check = CHECKS[name]
        rows = self.table(name)
        rows = in_report_order(rows, list(check.order)) if check.order else rows
        return rows.withColumns(
            {c: linkify(F.col(c), t, portal) for c, t in check.links.items() if c in rows.columns}
        )

    def _weights(self, source: str, unfiltered: bool) -> dict:
        out = {}
        for n in self.names:
            check = CHECKS[n]
            if check.weight and check.needs[0] == source and (n in UNFILTERED) == unfiltered:
                out[n] = check.weight(*self._dates(check))
        return out

    def _dates(self, check: Check) -> list[dt.date]:
        return [getattr(self, x) for x in ("as_of", "since") if x in check.needs]

    def hits(self) -> DataFrame:
        """(PID, check) of every publication row check, from one scan."""
        marks = [
            F.when(F.coalesce(w, F.lit(0)) > 0, F.lit(n)) for n, w in self._weights("pubs", False).items()
        ]
        rows = self.pubs.select("PID", F.array_compact(F.array(*marks)).alias("hits"))
        return rows.select("PID", F.explode("hits").alias("check"))

    def weighted_hits(self, *kept: str) -> DataFrame:
        """(PID, check, n, kept) of every publication row check: how many rows of the check's table a publication has.

        One scan, and no shuffle, so the publications may be a stream.
        """
        marks = [F.when(w > 0, F.struct(F.lit(n).alias("check"), w.cast("bigint").alias("n"))) for n, w in self._weights("pubs", False).items()]
        rows = self.pubs.select("PID", *kept, F.explode(F.array_compact(F.array(*marks))).alias("hit"))
        return rows.select("PID", "hit.*", *kept)

    def statistics(self) -> DataFrame:
        """(name, value): how many rows the table of each check has.

        Row checks are counted in one aggregate per table; checks whose rows are groups of publications in one more, with one
        shuffle of (check, key); checks of authors with their publications in a third. Only what is left (titles, people) runs
        as a table of its own.
        """
        parts, counted = [], set()
        for made in (self._row_statistics, self._group_statistics, self._linked_statistics):
            for names, part in made():
                counted |= names
                parts.append(part)
        rest = {n: self.table(n) for n in self.names if n not in counted}
        if self.external is not None:
            rest["external"] = self.external
        parts += [t.agg(F.count(F.lit(1)).alias("value")).select(F.lit(n).alias("name"), "value") for n, t in rest.items()]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _row_statistics(self):
        grouped = {n for n in self.names if CHECKS[n].groups or CHECKS[n].linked}
        inside = within_prefilter(self.as_of) if self.filtered else F.lit(True)
        pubs = {n: F.when(inside, w) for n, w in self._weights("pubs", False).items()} | self._weights("pubs", True)
        for table, weights in ((self.all_pubs, pubs), (self.authors, self._weights("authors", False))):
            weights = {n: w for n, w in weights.items() if n not in grouped}
            if weights:
                sums = table.agg(*[F.coalesce(F.sum(w), F.lit(0)).alias(n) for n, w in weights.items()])
                yield set(weights), sums.unpivot([], list(weights), "name", "value")

    def _group_statistics(self):
        kinds = {n: CHECKS[n].groups(*self._dates(CHECKS[n])) for n in self.names if CHECKS[n].groups}
        if not kinds:
            return
        width = max(len(g.key) for groups in kinds.values() for g in groups)

        def entry(name: str, g) -> Column:
            key = [k.cast("string") for k in g.key] + [F.lit(None).cast("string")] * (width - len(g.key))
            amount = F.lit(0) if g.amount is None else g.amount
            return F.when(g.where, F.struct(
                F.lit(name).alias("name"), *[k.alias(f"k{i}") for i, k in enumerate(key)], amount.cast("bigint").alias("amount")))

        entries = F.array_compact(F.array(*[entry(n, g) for n, groups in kinds.items() for g in groups]))
        inside = F.coalesce(within_prefilter(self.as_of), F.lit(False)) if self.filtered else F.lit(True)
        rows = self.all_pubs.select(inside.alias("inside"), F.explode(entries).alias("e")).select("inside", "e.*")
        sizes = rows.groupBy("name", *[f"k{i}" for i in range(width)]).agg(
            F.count_if("inside").alias("n"), F.count(F.lit(1)).alias("n_all"), F.max("amount").alias("amount"))
        value = F.expr("CASE name " + " ".join(f"WHEN '{n}' THEN {groups[0].value}" for n, groups in kinds.items()) + " END")
        found = sizes.groupBy("name").agg(F.sum(value).cast("bigint").alias("value"))
        names = F.explode(F.array(*map(F.lit, kinds))).alias("of")  # a check without any group counts, too
        named = self.all_pubs.sparkSession.range(1).select(names)
        yield set(kinds), named.join(found, F.col("of") == F.col("name"), "left").select(F.col("of").alias("name"), F.coalesce("value", F.lit(0)).alias("value"))

    def _linked_statistics(self):
        kinds = {n: CHECKS[n].linked for n in self.names if CHECKS[n].linked}
        if not kinds:
            return
        flags = {n: flag() for n, (flag, _) in kinds.items()}
        some = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags.values()])
        per_record = self.authors.where(some).groupBy("PID").agg(*[F.count_if(f).alias(n) for n, f in flags.items()])
        records = self.pubs.groupBy("PID").agg(F.count(F.lit(1)).alias("times"))
        times = {"inner": F.coalesce("times", F.lit(0)), "left": F.coalesce("times", F.lit(1))}
        sums = per_record.join(records, "PID", "left").agg(
            *[F.coalesce(F.sum(F.col(n) * times[how]), F.lit(0)).alias(n) for n, (_, how) in kinds.items()])
        yield set(kinds), sums.unpivot([], list(kinds), "name", "value")
