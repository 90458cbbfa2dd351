"""Stages whose summary is counted in the pass that writes their table.

Each takes the rows and a function that writes them, and returns the same summary
that the operator's own stats function would compute from the written table,
without reading it again. Values beyond the known ones count as `other`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill.functions.text import strip
from corpusmill.operators.dedupe import long_enough, near_duplicates
from corpusmill.operators.label import label_chunks
from corpusmill.operators.lint import lint_filter
from corpusmill.sources.ordered_corpus import SHARD_BYTES, write_ordered

Write = Callable[[DataFrame], None]
#: A measure of the rows for which a condition holds.
Measure = Callable[[Column], Column]

OTHER = "other"
TYPES = (fv.TYPE_MODULE, fv.TYPE_FILE, fv.TYPE_SECTION)
DOMAINS = ("uvm", "rtl", "doc")
_COUNT: dict[str, Measure] = {"n": F.count_if}


def _sum(column: Column) -> Measure:
    return lambda condition: F.coalesce(F.sum(F.when(condition, column)), F.lit(0)).cast("bigint")


def _by_value(column: str, values: Sequence[str], measures: dict[str, Measure]) -> list[Column]:
    """Each measure for each value, as one row of aggregates."""
    of = {v: F.col(column) == v for v in values}
    of[OTHER] = ~F.coalesce(F.col(column).isin(*values), F.lit(False))
    return [m(F.coalesce(c, F.lit(False))).alias(f"{v}|{name}") for v, c in of.items() for name, m in measures.items()]


def _rows(seen: dict, values: Sequence[str], measures: dict[str, Measure]) -> list[tuple]:
    """(value, measures...) of an observation of `_by_value`; zeros where nothing was seen."""
    return [(v, *[seen.get(f"{v}|{name}") or 0 for name in measures]) for v in (*values, OTHER)]


class _Counter:
    """Counts rows while an action runs over them."""

    def __init__(self, rows: DataFrame, *columns: Column) -> None:
        self._seen, self._rows, self._columns = Observation(), rows, columns
        self.rows = rows.observe(self._seen, *columns)

    def counts(self) -> dict:
        """After the action. Where adaptive execution found that nothing could come
        of the rows and left them out, they are counted now."""
        try:
            return self._seen.get
        except Py4JJavaError:
            return self._rows.agg(*self._columns).first().asDict()


def parse_counts(records: DataFrame, write: Write) -> DataFrame:
    """Records by type."""
    seen = _Counter(records, *_by_value("type", TYPES, _COUNT))
    write(seen.rows)
    rows = [row for row in _rows(seen.counts(), TYPES, _COUNT) if row[1]]
    return records.sparkSession.createDataFrame(rows, "type string, n_records bigint")


def dedupe_counts(records: DataFrame, order: Sequence[str], write: Write) -> DataFrame:
    """Removal of near-duplicates; per type and for `all`: records in, kept, percentage kept."""
    removed = near_duplicates(records, order)
    return kept_counts(records, lambda rows: long_enough(rows).join(removed, list(order), "left_anti"), write)


def kept_counts(records: DataFrame, keep: Callable[[DataFrame], DataFrame], write: Write) -> DataFrame:
    """The summary of `dedupe_counts` for any way to leave rows out."""
    before = _Counter(records, *_by_value("type", TYPES, _COUNT))
    after = _Counter(keep(before.rows), *_by_value("type", TYPES, _COUNT))
    write(after.rows)
    both = zip(_rows(before.counts(), TYPES, _COUNT), _rows(after.counts(), TYPES, _COUNT))
    rows = [(name, n_in, n_kept) for (name, n_in), (_, n_kept) in both if n_in]
    rows.append(("all", sum(r[1] for r in rows), sum(r[2] for r in rows)))
    told = [(name, n_in, n_kept, n_kept / max(1, n_in) * 100) for name, n_in, n_kept in rows]
    schema = "type string, n_in bigint, n_kept bigint, retained_pct double"
    return records.sparkSession.createDataFrame(told, schema)


def label_counts(records: DataFrame, write: Write) -> DataFrame:
    """Rule labels; the summary of `label_stats`."""
    measures = {
        "n_records": F.count_if,
        "n_with_assertion": lambda c: F.count_if(c & F.col("contains_assertion")),
        "n_with_register_map": lambda c: F.count_if(c & F.col("contains_register_map")),
        "sum_chars": _sum(F.col("n_chars").cast("bigint")),
    }
    seen = _Counter(label_chunks(records), *_by_value("domain", DOMAINS, measures))
    write(seen.rows)
    rows = [row for row in _rows(seen.counts(), DOMAINS, measures) if row[1]]
    schema = "domain string, " + ", ".join(f"{name} bigint" for name in measures)
    return records.sparkSession.createDataFrame(rows, schema)


def corpus_counts(chunks: DataFrame, path: str, order: Sequence[str], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The raw-text corpus in order; the summary of `cpt_stats`.

    Rows are counted and left out after they are in order, as a range
    partitioning reads its input twice.
    """
    n, seen = F.length("content"), []
    kept = n >= fv.CORPUS_MIN_CHARS
    measures = {"candidate_docs": F.count(F.lit(1)), "kept_docs": F.count_if(kept), "kept_chars": _sum(n)(kept)}

    def pick(rows: DataFrame) -> DataFrame:
        seen.append(_Counter(rows, *[m.alias(name) for name, m in measures.items()]))
        return seen[0].rows.filter(kept)

    write_ordered(chunks.withColumn("content", strip(F.col("content"))), path, order, shard_bytes, pick)
    counts = seen[0].counts()
    row = tuple(counts[name] or 0 for name in measures)
    return chunks.sparkSession.createDataFrame([row], ", ".join(f"{name} bigint" for name in measures))


def lint_counts(pairs: DataFrame, write: Write) -> DataFrame:
    """Pairs with `lint_status`, without the failed ones; the summary of `lint_stats`."""
    statuses = (fv.LINT_PASS, fv.LINT_FAIL, fv.LINT_NA, fv.LINT_UNAVAILABLE)
    seen = _Counter(pairs, *_by_value("lint_status", statuses, _COUNT))
    write(lint_filter(seen.rows))
    n = dict(_rows(seen.counts(), statuses, _COUNT))
    failed = n[fv.LINT_FAIL]
    row = (sum(n.values()), n[fv.LINT_PASS], failed, n[fv.LINT_NA] + n[fv.LINT_UNAVAILABLE], failed)
    schema = "n_pairs bigint, n_passed bigint, n_failed bigint, n_skipped bigint, n_dropped bigint"
    return pairs.sparkSession.createDataFrame([row], schema)


def split_counts(rows: DataFrame, write: Write) -> DataFrame:
    """Split pairs; the summary of `split_stats`."""
    seen = _Counter(rows, *_by_value("split", fv.SPLITS, _COUNT))
    write(seen.rows)
    told = [(name, n, n == 0 and name != "train") for name, n in _rows(seen.counts(), fv.SPLITS, _COUNT) if name != OTHER]
    return rows.sparkSession.createDataFrame(told, "split string, n_rows bigint, warn_empty boolean")
