"""Quality rules from base counts and from how many documents of a host share each line.

Only DataFrame functions are used. Base counts are taken inside each row. For the verdict, every
line with a word is normalised (lower case; blanks and punctuation dropped) and hashed.
Per host (column ``source``) and line the distinct document contents are counted: exact copies of
one document count once. A line above both limits (an absolute number, and a share of the host's
contents that stops growing at ENOUGH_DOCS, however large the host) is removed from every document of the host but the first (smallest doc_id) that has it.
A document is depleted, and rejected, if fewer than MIN_WORDS words or less than MIN_SHARE of its
words remain. quality() counts what is removed; cleaned() returns the kept texts without it.

Shuffles carry hashes only (cleaned() moves texts once, at every size): distinct (host, line, content) triples spread a hot host
and a hot line over all tasks before anything is counted, counts are combined on the map side, and
the join of lines to frequent lines is one that adaptive execution splits when a key is hot.

Defined cases: a null text has no words and fails the base rules; a null source is a host of its
own; a null doc_id is an id; rows that repeat an id and a text share one verdict; an empty table
gives an empty result; columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import SPACE, SPACES, cut, let, word_array

WINDOW = 8
#: A line is frequent if more than MAX_DOCS contents of its host and more than MAX_DOC_SHARE of them have it.
MAX_DOCS = 20
MAX_DOC_SHARE = 0.02
#: More contents than these are frequent whatever their share, so that a hot host hides no line.
ENOUGH_DOCS = 1000
MIN_WORDS = 5
MIN_SHARE = 0.3
DROPPED = SPACES + ".,;:!?'\"()-"


def twice_as_long(hashes: Column, half: int) -> Column:
    """Hashes of windows of 2 * half words from those of half."""
    return let(hashes, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + half))))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found at least twice in the array.

    Hashes of windows of 1, 2, 4 ... words come from pairs of those half as long. Most arrays repeat
    no window, which a hash set of longs tells. In the others the windows are sorted by hash, neighbours
    of one hash are verified word by word, and the union of those that repeat is measured in one fold.
    """
    if window & (window - 1):
        raise ValueError("windows are of 1, 2, 4, 8 ... words")
    at = lambda i: F.slice(words, i + 1, window)
    hashes, half = F.transform(words, lambda w: F.xxhash64(w)), 1
    while half < window:
        hashes, half = twice_as_long(hashes, half), 2 * half
    hashes = F.slice(hashes, 1, F.greatest(F.size(words) - (window - 1), F.lit(0)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def alike(a: Column, b: Column) -> Column:
            return F.coalesce((a["x"] == b["x"]) & (at(a["i"]) == at(b["i"])), F.lit(False))

        def repeated(s: Column) -> Column:
            """Which of the sorted windows equal the one before or after; each pair is compared once."""
            as_next = F.transform(s, lambda e, k: (k + 1 < F.size(s)) & alike(e, F.get(s, k + 1)))
            return let(as_next, lambda n: F.filter(s, lambda e, k: F.get(n, k) | ((k > 0) & F.get(n, F.greatest(k - 1, F.lit(0))))))

        again = let(ordered, repeated)
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(F.transform(again, lambda e: e["i"])),
            start,
            lambda a, p: F.struct((p + window).alias("end"), (a["n"] + p + window - F.greatest(a["end"], p)).alias("n")),
            lambda a: a["n"],
        )

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def parsed(docs: DataFrame) -> DataFrame:
    """All that is taken from a text, in one pass: doc_id, host, content (a hash of the text), row (an id of the row), base counts, and
    lines, which has pos (from 0), line (hash of the normalised line) and words of every line with a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id", F.col("source").alias("host"), F.xxhash64(text).alias("content"), F.monotonically_increasing_id().alias("row"), word_array(F.col("text")).alias("words"),
        F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("raw"))), lambda x: F.trim(x["raw"], F.lit(SPACES)) != "").alias("lines"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    line = lambda x: F.struct(
        x["pos"].alias("pos"), F.xxhash64(F.translate(F.lower(x["raw"]), DROPPED, "")).alias("line"), F.regexp_count(x["raw"], F.lit(f"[^{SPACE}]+")).alias("words")
    )
    return split.select(
        "doc_id", "host", "content", "row",
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct(F.col("lines.raw")))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform("lines", line).alias("lines"),
    )


def frequent_lines(lines: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_DOC_SHARE, enough: int = ENOUGH_DOCS) -> DataFrame:
    """host, line, n_docs and first_id of the lines above both limits, that of the share being enough at most."""
    once = lines.groupBy("host", "line", "content").agg(F.min("doc_id").alias("first_id"))
    n_docs = once.groupBy("host", "line").agg(F.count("*").alias("n_docs"), F.min("first_id").alias("first_id")).where(F.col("n_docs") > max_docs)
    hosts = lines.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    joined = n_docs.alias("l").join(hosts.alias("h"), F.col("l.host").eqNullSafe(F.col("h.host")))
    return joined.where(F.col("n_docs") > F.least(max_share * F.col("host_docs"), F.lit(float(enough)))).select("l.host", "line", "n_docs", "first_id")


def quality(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_DOC_SHARE, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE
) -> DataFrame:
    """doc_id, base counts, base_failed, kept and n_removed_words of every row of docs (doc_id, text, source)."""
    return verdicts(docs, max_docs, max_share, min_words, min_share).drop("host", "content", "gone")


def without(text: Column, gone: Column) -> Column:
    """text without its lines at the places gone (from 0), the others in order."""
    rest = lambda s: F.transform(F.array_except(F.sequence(F.lit(0), F.size(s) - 1), gone), lambda i: F.get(s, i))
    return let(F.split(text, "\n"), lambda s: F.array_join(rest(s), "\n"))


def cleaned(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_DOC_SHARE, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE
) -> DataFrame:
    """The rows of docs that quality() keeps, with all their columns, their texts without the lines that it removes.

    n_chars, where docs has it, is less by as many characters as text.
    """
    found = verdicts(docs, max_docs, max_share, min_words, min_share).where("not kept or n_removed_words > 0")
    # By merge at every size: the rows to change grow with the corpus, so texts move once, whatever their number.
    found = found.select("doc_id", "host", "content", "kept", F.when(F.col("kept"), F.col("gone")).alias("gone")).distinct().hint("merge")
    text = F.col("d.text")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("d.source").eqNullSafe(F.col("r.host")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("r.content"))
    left = docs.alias("d").join(found.alias("r"), same, "left").where(F.coalesce("r.kept", F.lit(True)))
    left = left.select(F.struct("d.*").alias("d"), F.when(F.col("r.gone").isNotNull(), without(text, F.col("r.gone"))).alias("less"))
    new = {"text": F.coalesce("less", text)}
    if "n_chars" in docs.columns:
        n = F.col("d.n_chars")
        new["n_chars"] = F.when(F.col("less").isNull(), n).otherwise((n - F.length(text) + F.length("less")).cast(docs.schema["n_chars"].dataType))
    return left.select(*(new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns))


def verdicts(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_DOC_SHARE, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """What quality() returns, with host and content, which tell rows that repeat a doc_id apart, and gone, the places of removed lines."""
    rows = cut(parsed(docs))
    lines = rows.select("doc_id", "host", "content", "row", F.inline("lines"))
    frequent = frequent_lines(lines, max_docs, max_share)
    hit = lines.alias("l").join(
        frequent.alias("f"),
        F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line") == F.col("f.line")) & ~F.col("l.doc_id").eqNullSafe(F.col("f.first_id")),
    )
    removed = hit.groupBy("row").agg(F.sum("words").cast("long").alias("removed"), F.sort_array(F.collect_list("pos")).alias("gone"))
    gone = F.coalesce(F.col("removed"), F.lit(0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - gone
    depleted = (gone > 0) & ((left < min_words) | (left < min_share * F.col("n_words")))
    return rows.drop("lines").join(removed, "row", "left").select(
        "doc_id", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), gone.alias("n_removed_words"), "gone",
    )
