"""Scalar functions on texts, names and labels. All are column expressions but nfkc(), which Spark has no function for."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTES = "\"'，。！？“”‘’"
PUNCTUATION = f"[,.!?{QUOTES} ]"
PUNCTUATION_AND_SPACE = f"[,.!?{QUOTES} \t\n\r]"
PAUSES = r"[,.!?;:。、！？；：，…—–\-]+"
RETRIABLE = "asr_access_failed"
CJK = ("zh", "ja", "ko")


def count_chars(text: Column) -> Column:
    """Characters that count for a speaking rate: no punctuation, quotes or white space."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), PUNCTUATION_AND_SPACE, ""))


def char_count(text: Column) -> Column:
    """As count_chars, but tabs and line ends count."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), PUNCTUATION, ""))


def pause_marks(text: Column) -> Column:
    """Groups of pause punctuation."""
    return F.coalesce(F.regexp_count(text, F.lit(PAUSES)), F.lit(0))


def nfkc(text: Column) -> Column:
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return normal(text)


def normal_for_wer(text: Column) -> Column:
    """Lower case, words and blanks only, NFKC, single blanks (T4)."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\w\s]", "")
    return F.trim(F.regexp_replace(nfkc(bare), r"(?U)\s+", " "))


def normal_for_cer(text: Column) -> Column:
    """Word characters only, NFKC, case kept (T5)."""
    return nfkc(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[^\w]", ""))


def cer(ref: Column, hyp: Column) -> Column:
    """Edits of characters per character of ref; 1 if either is empty."""
    return F.when((F.length(ref) == 0) | (F.length(hyp) == 0), 1.0).otherwise(F.levenshtein(ref, hyp) / F.length(ref))


def words(text: Column) -> Column:
    bare = F.trim(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s+"))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def wer(ref: Column, hyp: Column) -> Column:
    """Edits of words per word of ref; 1 if either is empty.

    Each distinct word of the two becomes one character, so that character distance is word
    distance. The characters reach to 35,000 distinct words, far above an utterance's.
    """
    r, h = words(ref), words(hyp)

    def as_text(ws: Column, known: Column) -> Column:
        sign = lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(known, w) + 19967), 4, "0")), "UTF-16BE")
        return F.array_join(F.transform(ws, sign), "")

    edits = let(F.array_distinct(F.concat(r, h)), lambda known: F.levenshtein(as_text(r, known), as_text(h, known)))
    return F.when((F.size(r) == 0) | (F.size(h) == 0), 1.0).otherwise(edits / F.size(r))


def has_error(error: Column) -> Column:
    """An error is neither null nor empty."""
    return F.coalesce(error != "", F.lit(False))


def classify_error(error: Column) -> Column:
    """Category of an error message."""
    bare = F.trim(F.substring_index(error, ":", 1))
    return (
        F.when(~has_error(error), "<none>")
        .when(F.contains(error, F.lit(RETRIABLE)), RETRIABLE)
        .when(F.contains(error, F.lit(":")), F.left(bare, F.lit(60)))
        .otherwise(F.left(error, F.lit(40)))
    )


def extension(path: Column) -> Column:
    """Lower-cased extension without the dot; names that only begin with dots have none."""
    return F.lower(F.regexp_extract(path, r"(?s)(?:^|/)\.*[^/.][^/]*\.([^/.]*)$", 1))


def unexplained_silences(silences: Column, text: Column) -> Column:
    """Silences that no pause mark explains; -1 stays."""
    return F.when(silences < 0, silences).otherwise(F.greatest(F.lit(0), silences - pause_marks(text)))


def speaking_rate(chars: Column, voiced: Column) -> Column:
    """Characters per voiced second, -1 where it can't be told; unrounded."""
    return F.when((voiced > 0) & (chars > 0), chars / voiced).otherwise(-1.0)


def spell_score(errors: Column, text: Column, language: Column) -> Column:
    """Part of units without a spelling error, 0 to 1."""
    unit = F.when(language.isin(*CJK), F.length(text) / 4.0).otherwise(F.size(words(text)).cast("double"))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - errors / F.greatest(unit, F.lit(1.0))))


def perplexity(loss: Column, tokens: Column) -> Column:
    """exp(loss), 1e21 from a loss of 50 on, -1 for fewer than two tokens."""
    return F.when(F.coalesce(tokens, F.lit(0)) < 2, -1.0).when(loss >= 50, 1e21).otherwise(F.exp(loss))


def json_in(answer: Column) -> Column:
    """The first flat JSON object in a model's answer, code fences aside."""
    found = F.regexp_extract(F.regexp_replace(answer, "```(?:json)?", ""), r"(?s)\{[^}]+\}", 0)
    return F.when(found != "", found)


def short_hash(text: Column, n: int = 8) -> Column:
    return F.left(F.sha1(text), F.lit(n))


LANGUAGES = {
    "chinese": "zh", "english": "en", "cantonese": "yue", "arabic": "ar", "german": "de", "french": "fr", "spanish": "es", "portuguese": "pt",
    "indonesian": "id", "italian": "it", "korean": "ko", "russian": "ru", "thai": "th", "vietnamese": "vi", "japanese": "ja", "turkish": "tr",
    "hindi": "hi", "malay": "ms", "dutch": "nl", "swedish": "sv",
}


def language_code(name: Column) -> Column:
    """ISO code of a language's English name; codes and unknown names stay, lower-cased."""
    known = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    low = F.lower(F.trim(name))
    return F.coalesce(F.try_element_at(known, low), low)


def snap(value: Column, allowed: list[str], default: str = "unknown") -> Column:
    """The allowed value that equals value, or equals it but for case and outer blanks; else the default (P25)."""
    exact = F.when(value.isin(*allowed), value)
    loose = F.create_map(*(F.lit(x) for a in dict((a.lower(), a) for a in reversed(allowed)).items() for x in a))
    other = default if default in allowed else allowed[-1]
    return F.coalesce(exact, F.try_element_at(loose, F.lower(F.trim(value))), F.lit(other))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Length of what two intervals share."""
    return F.greatest(F.lit(0.0), F.least(e1, e2) - F.greatest(s1, s2))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; null where sizes differ or a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norm > 0), F.try_divide(dot(a, b), norm))


def rewrite_prefix(path: Column, rules: list[tuple[str, str]]) -> Column:
    """path with the first of the prefixes that fits replaced."""
    out = path
    for old, new in reversed(rules):
        out = F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(out)
    return out


def duration_text(seconds: Column) -> Column:
    """Days, hours and minutes, without leading zero parts; N/A for null or negative."""
    s = F.floor(seconds).cast("long")
    d, h, m = F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60)
    text = F.when(d > 0, F.format_string("%dd %dh %dm", d, h, m)).when(h > 0, F.format_string("%dh %dm", h, m)).otherwise(F.format_string("%dm", m))
    return F.when(seconds >= 0, text).otherwise("N/A")


def short_path(path: Column, n: int = 3) -> Column:
    """The last components of a path."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -n)


def bar(part: Column, width: int = 20) -> Column:
    """A bar for a part of 1."""
    full = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)) * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), width - full))


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm; hours wrap at 24 (K9)."""
    ms = F.floor(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000) % 24, F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def file_id(stem: Column) -> Column:
    """A file's stem without quotes and blanks."""
    return F.regexp_replace(stem, "[\"' ]", "")


def retention(line: Column) -> Column:
    """The per cent that a log line reports."""
    return F.try_element_at(F.regexp_extract_all(line, F.lit(r"(?i)retain\w*\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*%?"), 1), F.lit(1)).cast("double")


def decode_timeout(duration: Column, base: float = 120.0) -> Column:
    """Seconds that decoding may take."""
    return F.greatest(F.lit(base), 60 + F.floor(duration / 24))


def speaker_name(path: Column, suffix: Column, n: int = 8) -> Column:
    """A speaker's name that is stable for a file."""
    return F.concat(F.lit("SPK_"), short_hash(path, n), F.lit("_"), suffix)


def bucket(x: Column, edges: list[float], names: list[str]) -> Column:
    """The name of the bucket of x; edges belong to the upper bucket."""
    out = F.lit(names[-1])
    for edge, name in zip(reversed(edges), reversed(names[:-1]), strict=True):
        out = F.when(x < edge, name).otherwise(out)
    return F.when(x.isNotNull(), out)


COARSE = ([4.0, 8.0, 15.0], ["<4", "4-8", "8-15", ">=15"])
FINE = ([3.0, 5.0, 7.0, 9.0, 12.0, 15.0], ["0-3", "3-5", "5-7", "7-9", "9-12", "12-15", "15+"])
