"""Personal data: regular expressions propose spans, checks confirm them, words nearby adjust a score.

Base kinds (email, ip, card, phone) stand on pattern and check alone. The method adds, if their score
reaches MIN_SCORE:
  card   13 to 15 digits that pass Luhn:         0.4, and 0.3 if a word for cards is near
  phone  three, three and four digits, no plus:  0.2, and 0.5 if a word for telephones is near
  iban   two letters, two digits, 11 to 30 more: 0.7 if the rest of a division by 97 is 1, and 0.3 for a near word
  secret 20 or more letters, digits, _ and -, with a letter and a digit: 0.2, and 0.5 if a word for secrets is near
A word is near if it is in the NEAR characters before the span. Added spans never overlap base ones.

Only DataFrame functions are used, inside each row: there is no shuffle. Splitting by a pattern gives
the text between its matches, so the sums of lengths are the positions, and the NEAR characters
before a match are kept from one to the next, earlier matches included. Patterns are possessive
where that can't change a match, and start only where a run starts or the last match ended, so
that long runs are scanned once and never recursed into; texts without a kind's telling character skip it.

Defined cases: a null text counts as empty; a null doc_id is passed on; repeated rows are repeated;
an empty table gives an empty result; columns other than doc_id and text are ignored. Positions
are in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.7
NEAR = 40
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BARE_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)(?![A-Za-z0-9])"
CARD_WORD = r"(?i)\b(card|credit|debit|visa|amex|mastercard|karte|carte|tarjeta)\b"
PHONE_WORD = r"(?i)\b(phone|tel|telephone|call|mobile|fax|telefon|téléphone|teléfono)\b"
IBAN_WORD = r"(?i)\b(iban|account|bank|konto|compte|cuenta)\b"
SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
SECRET_WORD = r"(?i)\b(token|secret|api[_-]?key|password|passwd|credentials?|bearer)\b"
SPAN = "array<struct<s:int,e:int>>"
KINDS = ("email", "ip", "card", "phone", "iban", "secret")


def matches(text: Column, pattern: str, accept: Callable[[Column, Column], Column]) -> Column:
    """Spans (s, e) of the leftmost matches of pattern for which accept(match, the NEAR characters before it) holds."""
    both = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), 0))),
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), last(gap).alias("between"), m.alias("m")),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + x["size"]
        before = last(F.concat(acc["tail"], x["between"]))
        out = F.when(accept(x["m"], before), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e")))).otherwise(acc["out"])
        return F.struct(e.alias("at"), last(F.concat(acc["tail"], x["between"], last(x["m"]))).alias("tail"), out.alias("out"))

    return F.aggregate(both, start, step, lambda acc: acc["out"])


def last(text: Column) -> Column:
    return F.right(text, F.lit(NEAR))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def near(before: Column, words: str) -> Column:
    return before.rlike(words)


def card_ok(m: Column) -> Column:
    d = digits(m)
    return F.length(d).between(16, 19) & F.call_function("luhn_check", d)


def short_card_score(m: Column, before: Column) -> Column:
    d = digits(m)
    return F.when(F.length(d).between(13, 15) & F.call_function("luhn_check", d), F.lit(0.4) + F.when(near(before, CARD_WORD), 0.3).otherwise(0.0)).otherwise(0.0)


def phone_ok(m: Column) -> Column:
    return F.length(digits(m)).between(8, 15)


def mod97(m: Column) -> Column:
    """The rest of a division by 97 of an IBAN, its first four characters moved to the end and letters as 10 to 35."""
    s = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substring(s, 5, 60), F.left(s, F.lit(4))), "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(moved, F.lit(0), lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def iban_score(m: Column, before: Column) -> Column:
    size = F.length(F.replace(m, F.lit(" "), F.lit("")))
    return F.when(size.between(15, 34) & (mod97(m) == 1), F.lit(0.7) + F.when(near(before, IBAN_WORD), 0.3).otherwise(0.0)).otherwise(0.0)


def secret_score(m: Column, before: Column) -> Column:
    mixed = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.when(mixed, F.lit(0.2) + F.when(near(before, SECRET_WORD), 0.5).otherwise(0.0)).otherwise(0.0)


def clear_of(spans: Column, base: Column) -> Column:
    return F.filter(spans, lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))


def listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))


def find(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, n_secret and n_spans of each row of docs (doc_id, text)."""
    text = F.col("text")
    none = F.array().cast(SPAN)
    rows = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("digit", text.rlike("[0-9]"))
    when = lambda test, found: F.when(test, found).otherwise(none)
    digit, enough = F.col("digit"), lambda p: F.col("digit") & text.rlike(p)
    always = lambda m, before: F.lit(True)
    rows = rows.select(
        "doc_id",
        when(F.contains(text, F.lit("@")), matches(text, EMAIL, always)).alias("email"),
        when(enough(r"[0-9]\.[0-9]"), matches(text, IP, lambda m, before: m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))).alias("ip"),
        when(digit, matches(text, CARD, lambda m, before: card_ok(m))).alias("card"),
        when(F.contains(text, F.lit("+")) & digit, matches(text, PHONE, lambda m, before: phone_ok(m))).alias("phone"),
        when(enough(CARD_WORD), matches(text, CARD, lambda m, before: short_card_score(m, before) >= min_score)).alias("short_card"),
        when(enough(PHONE_WORD), matches(text, BARE_PHONE, lambda m, before: F.lit(0.2) + F.when(near(before, PHONE_WORD), 0.5).otherwise(0.0) >= min_score)).alias("bare_phone"),
        when(enough("[A-Z]{2}[0-9]{2}"), matches(text, IBAN, lambda m, before: iban_score(m, before) >= min_score)).alias("iban"),
        when(enough(SECRET_WORD), matches(text, SECRET, lambda m, before: secret_score(m, before) >= min_score)).alias("secret"),
    )
    base = F.concat("email", "ip", "card", "phone")
    rows = rows.select("*", *(clear_of(F.col(c), base).alias(f"more_{c}") for c in ("short_card", "bare_phone", "iban", "secret")))
    base_list = F.concat(*(listed(k, F.col(k)) for k in KINDS[:4]))
    spans = F.concat(
        listed("email", F.col("email")), listed("ip", F.col("ip")),
        listed("card", F.sort_array(F.concat("card", "more_short_card"))), listed("phone", F.sort_array(F.concat("phone", "more_bare_phone"))),
        listed("iban", F.col("more_iban")), listed("secret", F.col("more_secret")),
    )
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(F.array_join(base_list, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(spans, ",").alias("spans"),
        F.size("more_iban").cast("long").alias("n_iban"), F.size("more_secret").cast("long").alias("n_secret"), F.size(spans).cast("long").alias("n_spans"),
    )
