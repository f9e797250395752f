"""Quality rules: base counts of every text, and cross-document line frequency by host.

Lines are normalised (lower case, single spaces, digits as 0) and hashed; the distinct documents
of a host that hold a line are counted. Lines found in more documents than the limit are removed,
and a document that loses more than a share of its words that way is rejected. The limit of a host
is a share of its documents, with a least number. All steps are SQL functions. Texts are read again
only where they lose lines; up to there a line is its hash, its place and its number of words.

Nulls: a null text has no words and fails the base rules; a null host is a host of its own; a null
doc_id is counted like any other document. Rows that repeat a doc_id count once per line and host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import SPACE, SPACES, free_name, key_text
from stratiscore.sources.staging import Workspace

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEAST_DOCUMENTS = 20
HOST_SHARE = 0.005
MAX_REMOVED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_DIGITS = ("0123456789", "0000000000")


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    ``lines``: hash, place and number of words of each normalised line that has words."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    rows = docs.select(
        *keep,
        F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE)).alias("words"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("full"),
        F.split(
            F.translate(F.lower(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")), *_DIGITS), "\n"
        ).alias("plain"),
    )
    rows = rows.select(
        *keep, "word_chars", "n_symbols", "words",
        F.size("words").alias("n_words"),
        (F.size("full") - F.size(F.array_distinct("full"))).alias("n_dup_lines"),
        F.expr(
            """transform(filter(transform(plain, (x, i) -> struct(trim(x) as x, i)), l -> l.x <> ''),
                 l -> struct(xxhash64(l.x) as h, l.i as i, size(split(l.x, ' ')) as n))"""
        ).alias("lines"),
    )
    rows = rows.select(
        *keep, "word_chars", "n_symbols", "n_words", "n_dup_lines", "lines",
        F.expr(
            """if(n_words < 3, array(), transform(slice(words, 1, n_words - 2),
                 (w, i) -> xxhash64(w, get(words, i + 1), get(words, i + 2))))"""
        ).alias("windows"),
    )
    # Only texts in which some window comes again pay for the ordering below.
    again = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.select(
        *keep, "word_chars", "n_symbols", "n_words", "n_dup_lines", "lines",
        F.when(again, F.expr("array_sort(transform(windows, (h, i) -> struct(h, i)))")).alias("sorted"),
    )
    places = """sort_array(transform(filter(sorted, (x, i) ->
        x.h <=> get(sorted, i - 1).h or x.h <=> get(sorted, i + 1).h), x -> x.i))"""
    covered = """aggregate(places, struct(-3 as last, 0 as n),
        (a, p) -> struct(p as last, a.n + least(3, p - a.last) as n), a -> a.n)"""
    return rows.withColumn("places", F.expr(places)).select(
        *keep,
        F.col("n_words").cast("long"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        F.col("n_dup_lines").cast("long"),
        F.coalesce(F.expr(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        "lines",
    )


_KEY = ["doc_id", "host", "text_hash"]  # rows equal in these lose the same lines


def _keyed(docs: DataFrame, host: str, *columns: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", key_text(host).alias("host"), F.xxhash64(text).alias("text_hash"), *columns)


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    same = left["host"].eqNullSafe(right["host"]) & (left["text_hash"] == right["text_hash"])
    return same & left["doc_id"].eqNullSafe(right["doc_id"])


def without_lines(text: Column, gone: Column) -> Column:
    """A text without the lines at the given places, counted from 0."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")


def judge(
    workspace: Workspace,
    docs: DataFrame,
    host: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    least_documents: int = LEAST_DOCUMENTS,
    host_share: float = HOST_SHARE,
    max_removed_percent: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """The verdict on every row, without its text: its key, the base counts, base_failed,
    n_line_words, kept, ``plain_sha256`` of the text, and the places of its ``gone`` lines or null."""
    text = F.coalesce("text", F.lit(""))
    named = _keyed(docs, host, F.sha2(text, 256).alias("plain_sha256"), F.col("text"))
    counted = base_counts(named, [*_KEY, "plain_sha256"])
    table = workspace.stage(counted.withColumn("row", F.monotonically_increasing_id()), "base-counts")
    lines = table.select("doc_id", "host", "row", F.explode("lines").alias("line"))
    lines = lines.select("doc_id", "host", "row", "line.*")
    # Distinct rows of a repeated id count once: first one row per line and document.
    held = lines.select("host", "h", F.coalesce("doc_id", -F.col("row") - 1).alias("d")).distinct()
    found = held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("documents"))
    # Spark weighs the staged sizes and frequent lines and broadcasts them only while they are small.
    sizes = table.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    sizes = workspace.stage(sizes, "host-sizes")
    limit = F.greatest(F.lit(float(least_documents)), F.col("host_documents") * host_share)
    frequent = found.filter(F.col("documents") > least_documents).join(sizes, "host")
    frequent = workspace.stage(frequent.filter(F.col("documents") > limit).select("host", "h"), "frequent-lines")
    lost = lines.join(frequent, ["host", "h"]).groupBy("row").agg(
        F.sum("n").alias("n_line_words"), F.array_sort(F.collect_list("i")).alias("gone")
    )
    joined = table.drop("lines").join(lost, "row", "left").drop("row")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    words = F.coalesce("n_line_words", F.lit(0)).cast("long")
    depleted = 100 * words > max_removed_percent * F.col("n_words")
    return joined.select(
        *_KEY, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), words.alias("n_line_words"), (~failed & ~depleted).alias("kept"),
        "plain_sha256", "gone",
    )


def _shortened(docs: DataFrame, host: str, judged: DataFrame) -> DataFrame:
    """Key and digest of the remaining text of the documents that lose lines, one row for each key."""
    lost = judged.filter("gone is not null").select(*_KEY, "gone").distinct()
    rows = _keyed(docs, host, F.col("text"))
    cut = rows.join(lost, _same_key(rows, lost))
    digest = F.sha2(without_lines(rows["text"], lost["gone"]), 256).alias("cut_sha256")
    return cut.select(*[rows[k] for k in _KEY], digest).groupBy(*_KEY).agg(F.max("cut_sha256").alias("cut_sha256"))


def apply_rules(
    workspace: Workspace, docs: DataFrame, host: str = "source", **limits: float
) -> DataFrame:
    """doc_id, the base counts, base_failed, n_line_words, kept, and kept_sha256 of the text that
    remains when the frequent lines are gone."""
    judged = workspace.stage(judge(workspace, docs, host, **limits), "judged")
    cut = _shortened(docs, host, judged)
    joined = judged.join(cut, _same_key(judged, cut), "left")
    digest = F.coalesce(cut["cut_sha256"], judged["plain_sha256"]).alias("kept_sha256")
    counts = [c for c in judged.columns if c not in (*_KEY, "plain_sha256", "gone")]
    return joined.select(judged["doc_id"], *[judged[c] for c in counts], digest)


def remove_lines(
    workspace: Workspace, docs: DataFrame, host: str = "source", **limits: float
) -> DataFrame:
    """The documents that the rules keep, with all their columns and without the frequent lines.

    Rows without a frequent line keep their text as it is, a null one too where the limits let it pass.
    """
    judged = workspace.stage(judge(workspace, docs, host, **limits), "judged")
    named = free_name(docs, "verdict")
    verdict = judged.select(*_KEY, "kept", "gone").distinct().select(F.struct("*").alias(named))
    v = F.col(named)
    same = v["doc_id"].eqNullSafe(docs["doc_id"]) & (v["host"] == key_text(host))
    same &= v["text_hash"] == F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    kept = docs.join(verdict, same).filter(v["kept"])
    text = F.when(v["gone"].isNull(), F.col("text")).otherwise(without_lines(F.col("text"), v["gone"]))
    return kept.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
