"""Operators on documents against brute force, over every case of the fixture and empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from loomspark.llm import bpe, counts, dedup, langid, mixing, pii, quality, simhash

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(expected)


def test_quality_base(docs, cases, none):
    def expect(doc_id, text):
        text, w = text or "", words(text)
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        return (doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w))

    got = quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same(got, [expect(c[0], c[1]) for c in cases])
    assert quality.quality(none).count() == 0


def test_quality_repeats_of_many_words(spark):
    """Texts of few words, whose windows begin and end alike without being equal, against a count of the windows."""
    import random

    r = random.Random(9)
    texts = [" ".join(r.choice("abc"[: r.choice([2, 3])]) for _ in range(r.randint(8, 120))) for _ in range(60)]
    start = "the same eight words begin and end it"
    texts += [f"{start} " + " ".join(f"{r.choice(['the', 'same'])} x{i}" for i in range(200)) + f" {start}", " ".join(["w"] * 9), " ".join(["w"] * 8)]

    def brute(text):
        w = words(text)
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        return len({i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)})

    got = quality.quality(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")).select("doc_id", "n_repeat_words").collect()
    assert dict(map(tuple, got)) == {i: brute(t) for i, t in enumerate(texts)}
    hashes = spark.createDataFrame([(list("abcdabce"),)], "w array<string>").select(quality.F.transform("w", lambda x: quality.F.xxhash64(x)).alias("h")).select(quality.twice_as_long(quality.F.col("h"), 1).alias("h")).first()["h"]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[5] and len(set(hashes[:7])) == 5


@pytest.mark.parametrize("limit", [0, 5])
def test_quality_lines(docs, cases, limit):
    drop = str.maketrans("", "", quality.DROPPED)
    docs_of, first, hosts = defaultdict(set), {}, defaultdict(set)
    key = lambda i: (i is None, i or 0)
    for doc_id, text, _, source, *_ in cases:
        for line in (text or "").split("\n"):
            if words(line):
                at = (source, line.lower().translate(drop))
                docs_of[at].add(text)
                first[at] = min(first.get(at, key(doc_id)), key(doc_id))
                hosts[source].add(text)
    expected = []
    for doc_id, text, _, source, *_ in cases:
        gone = 0
        for line in (text or "").split("\n"):
            at = (source, line.lower().translate(drop))
            if words(line) and len(docs_of[at]) > limit and len(docs_of[at]) > 0.1 * len(hosts[source]) and first[at] != key(doc_id):
                gone += len(words(line))
        expected.append((doc_id, gone))
    same(quality.quality(docs, max_docs=limit, max_share=0.1).select("doc_id", "n_removed_words").collect(), expected)


def test_quality_rejects_the_depleted(spark):
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{body}\nown {i}", "s") for i in range(9)] + [(100 + i, " ".join(f"w{i}x{k}" for k in range(30)), "s") for i in range(9)] + [(200, f"{body}\nown 0", "t")]
    df = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_docs=5)
    assert {r["doc_id"] for r in df.where("kept").collect()} == {0, 200, *range(100, 109)}


def test_quality_lines_of_a_hot_host(spark):
    """A line of 1,112 contents is frequent in a host of 60,000, where the share alone would ask for more than 1,200."""
    from pyspark.sql import functions as F

    body = F.concat(F.lit("own "), F.col("id").cast("string"), F.lit(" a b c d e f g h i j k l m n o p q r s t"))
    docs = spark.range(60000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 54 == 0, F.concat(body, F.lit("\nAll rights reserved."))).when(F.col("id") % 61 == 0, F.concat(body, F.lit("\nRarer line"))).otherwise(body).alias("text"), F.lit("hot").alias("source"))
    got = {r["doc_id"] for r in quality.quality(docs).where("n_removed_words > 0").collect()}
    assert got == set(range(54, 60000, 54))


def test_quality_removes_the_lines(spark):
    """Frequent lines leave the texts of all but the first document; order, blank lines and other columns stay."""
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(20))
    text = lambda i: f"Menu: home, news\n{own(i)}\n\nmenu home news\nlast {i}\nAll rights reserved."
    rows = [(i, text(i), "s", len(text(i)), i % 2 == 0) for i in range(9)] + [(3, text(3), "s", len(text(3)), False), (None, text(50), "s", len(text(50)), True), (9, text(9), "t", 1, True), (10, "short", "s", 5, True)]
    got = quality.cleaned(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, kept boolean"), max_docs=5)
    less = lambda i: f"{own(i)}\n\nlast {i}"
    expected = [(i, text(i) if i == 0 or s == "t" else less(50 if i is None else i), s, n, k) for i, _, s, n, k in rows[:-1]]
    expected = [(i, t, s, n if i == 0 or s == "t" else len(t), k) for i, t, s, n, k in expected]
    same(got.collect(), expected)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "string", "int", "boolean"]


def test_language(docs, cases, none, spark):
    got = langid.identify(docs).collect()
    assert len(got) == len(cases) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    letters = {c[0]: any(ch.isalpha() for ch in c[1] or "") for c in cases if c[0] is not None and c[0] != 3}
    for r in got:
        if r["doc_id"] in letters:
            assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]])
    assert langid.identify(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.identify(unlabelled).select("lang_pred", "score").collect()] == [("und", 0.0)]


def test_language_accuracy(spark):
    import random

    r = random.Random(1)
    make = lambda parts: " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(20))
    parts = {"en": ["the", "ing", "and", "er"], "fr": ["é", "eau", "le", "oi"], "de": ["sch", "ü", "ung", "ein"]}
    rows = [(i, make(parts[x]), x) for i, x in enumerate(["en", "fr", "de"] * 60)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    truth = {i: x for i, _, x in rows}
    assert len(got) > 20 and all(truth[g["doc_id"]] == g["lang_pred"] for g in got)


def test_language_scores_are_the_dense_product():
    """Sparse scores against a plain loop over n-grams, at full width and with a bit less, short and long texts."""
    import random

    r = random.Random(4)
    texts = ["".join(r.choice("abcdeé .,1") for _ in range(n)) for n in (1, 3, 40, 2000, 150_000)] + [None, "", "12 34", "a"]
    rng = np.random.default_rng(1)
    for less in (0, 3):
        logs, prior = rng.normal(-9, 1, (1 << (langid.BITS - less), 3)).astype(np.float32), np.log([0.5, 0.3, 0.2])
        langs, scores = langid.predict_batch(texts, ["x", "y", "z"], logs, prior, less)
        for t, lang, score in zip(texts, langs, scores, strict=True):
            found = [langid.features(piece)[0] for _, piece in langid.blocks([t])]
            total = sum((logs[f >> np.uint32(less)].sum(axis=0, dtype=np.float64) for f in found), np.zeros(3))
            n = sum(map(len, found))
            assert lang == ("xyz"[int((total + prior).argmax())] if n else "und")
            tempered = total * min(1, langid.TEMPER / max(n, 1)) + prior
            assert score == pytest.approx(np.exp(tempered[(total + prior).argmax()] - np.logaddexp.reduce(tempered)) if n else 0, rel=1e-4)


def test_language_evidence_beats_the_prior():
    """Long texts go by what they say, however rare their language is."""
    logs = np.full((1 << langid.BITS, 2), -9, np.float32)
    logs[:, 1] += 0.02
    langs, _ = langid.predict_batch(["abc def " * 200], ["common", "rare"], logs, np.log([0.9999, 0.0001]))
    assert langs == ["rare"]


def test_language_many_languages_in_a_small_matrix(spark):
    """With ten times as many languages as the matrix has room for, hashes lose bits and every language is still told."""
    alphabet = [chr(0x4E00 + 50 * k + j) for k in range(30) for j in range(50)]
    rows = [(i, "".join(alphabet[50 * (i % 30) + (7 * i + j * j) % 50] for j in range(40)), f"l{i % 30:02d}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, logs, _, less = langid.train(docs, max_matrix=3 * 4 << langid.BITS)
    assert len(langs) == 30 and less == 4 and logs.nbytes <= 3 * 4 << langid.BITS
    got = langid.identify(docs, max_matrix=3 * 4 << langid.BITS).where("held_out").collect()
    assert sum(g["lang_pred"] == rows[g["doc_id"]][2] for g in got) >= 0.95 * len(got) > 50


def test_token_counts(docs, cases, none):
    encode = counts.encoding("byte_bpe_50k.tiktoken").encode_ordinary
    n = [len(encode(c[1] or "")) for c in cases]
    table = counts.length_table(counts.lengths(docs)).cache()
    expected = [(x, n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x), sum(y < x for y in n), sum(y for y in n if y < x), sum(min(x, y) for y in n)) for x in set(n)]
    same(table.drop("share_below").collect(), expected)
    for limit in (0, 1, 7, 100, 10**6):
        assert counts.truncated_total(table, limit).first()[0] == sum(min(limit, x) for x in n)
    for q in (0.1, 0.5, 0.9, 1.0):
        assert counts.quantile(table, q).first()[0] == sorted(n)[max(0, int(np.ceil(q * len(n) - 1e-9)) - 1)]
    assert counts.length_table(counts.lengths(none)).count() == 0


def test_length_blocks(spark):
    rows = [(x,) for x in [0, 0, 5, 1023, 1024, 1025, 5000, 5000, 99999]]
    got = {r["n_tokens"]: (r["docs_below"], r["tokens_below"]) for r in counts.length_table(spark.createDataFrame(rows, "n_tokens long")).collect()}
    assert got == {x: (sum(y < x for (y,) in rows), sum(y for (y,) in rows if y < x)) for (x,) in rows}


def filled(sizes, weights, cap):
    """Targets by sharing what is above a limit again and again."""
    total, target, open_ = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while left > 1e-9 * max(total, 1) and open_:
        w = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / w for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def test_mixing(docs, cases, none):
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for c in cases:
        sizes[c[3]] += len(words(c[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken, largest = defaultdict(int), max(r["size"] for r in got)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(cases) and all(abs(taken[s] - target[s]) <= largest for s in sizes)
    same(mixing.mix(docs.repartition(7)).collect(), got)
    assert mixing.mix(none).count() == 0


def test_targets_stop_at_the_limit(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, "d": 500, "e": 0}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    expected = filled(sizes, dict(zip("abcde", (5, 2, 1, 5, 2), strict=True)), 3)
    assert got == {s: pytest.approx(x) for s, x in expected.items()}


def test_mixed_rows(docs):
    takes = Counter()
    for r in mixing.mix(docs).collect():
        takes[r["doc_id"]] += r["copies"]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in takes.items() if v})


def brute_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids):
    """Smallest id of each fingerprint's component."""
    distinct, parent = sorted(set(fps)), {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for f, i in zip(fps, ids, strict=True):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return {f: least.get(find(f)) for f in distinct}


def test_simhash(docs, cases, none):
    fps = [brute_fingerprint(c[1]) for c in cases]
    comp = brute_components(fps, [c[0] for c in cases])
    got = simhash.near_dedup(docs).collect()
    same(got, [(c[0], f"{f:016x}", comp[f]) for c, f in zip(cases, fps, strict=True)])
    assert simhash.near_dedup(none).count() == 0


@pytest.mark.parametrize("bucket", [2, 4, 64])
def test_links_lose_none(spark, bucket):
    """Clouds of fingerprints so dense that buckets overflow at a small limit."""
    import random

    r = random.Random(bucket)
    fps = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(25):
            f = centre
            for b in r.sample(range(64), r.randint(0, 4)):
                f ^= 1 << b
            fps.add(f)
        half = centre & (2**32 - 1)
        fps |= {half | r.getrandbits(32) << 32 for _ in range(20)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from loomspark.llm.graph import components

    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bucket=bucket)
    got = {x["node"]: x["component"] for x in components(edges, "u", "v").collect()}
    expected = brute_components(list(fps), [f - (1 << 64) if f >> 63 else f for f in fps])
    for f, s in zip(fps, signed, strict=True):
        assert got.get(s, s) == expected[f]


def test_components_of_a_chain_and_a_star(spark):
    from loomspark.llm.graph import components

    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + i: 1000 for i in range(60)}


def test_encoding(docs, cases, none):
    t = Tokenizer.from_file(bpe.public_path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    expected = []
    for c in cases:
        ids = t.encode(c[1] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        expected.append((c[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    same(bpe.encode_texts(docs).collect(), expected)
    assert bpe.encode_texts(none).count() == 0


def test_encoder_against_the_library():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    ours = bpe.tokenizer(bpe.public_path("word_bpe_49k.json"))
    library = Tokenizer.from_file(bpe.public_path("word_bpe_49k.json"))
    texts = st.one_of(st.text(max_size=60), st.text(alphabet="abcdeinorst '.!<|>éß", max_size=60), st.text(alphabet="ab", max_size=300))

    odd = ["a\u0345b c\u1e9eD", "x \u0301y e\u0301 \u1e00\u0301", "\u2028word\u2029 \x85a\x1cb\xa0c", "ok \U0001f600\u200d\U0001f525 \u0378fine \u10d0\u1c90 end", "\u03a3\u0397\u03a3 \u0130x it'\u017f"]

    def agree(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == ids

    for text in odd:
        agree(text)
        agree(f"plain words before {text} and after, {text}")

    @settings(max_examples=400, deadline=None)
    @given(texts)
    def check(text):
        ids = library.encode(text, add_special_tokens=False).ids
        mine = ours.encode(text)
        assert np.frombuffer(mine, "<u4").tolist() == ids
        assert ours.decode(mine).decode() == library.decode(ids, skip_special_tokens=False)

    check()


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def test_pii(docs, cases, none):
    bare = lambda m: re.sub("[^0-9]", "", m)
    base = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(bare(m)) <= 19 and luhn(bare(m))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(bare(m)) <= 15),
    ]
    expected, found = [], {}
    for c in cases:
        spans = [(k, m.start(), m.end()) for k, p, ok in base for m in re.finditer(p, c[1] or "") if ok(m[0])]
        n = Counter(k for k, *_ in spans)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        expected.append((c[0], n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(listed.encode()).hexdigest()))
        found[c[0]] = set(listed.split(",")) - {""}
    got = pii.find(docs).cache()
    same(got.drop("spans", "n_iban", "n_secret", "n_spans").collect(), expected)
    assert all(r["n_spans"] == len([x for x in r["spans"].split(",") if x]) for r in got.collect())
    by_id = {r["doc_id"]: r["spans"] for r in got.collect()}
    assert all(found[i] <= set(s.split(",")) for i, s in by_id.items() if i is not None and i != 3)
    text = {c[0]: c[1] for c in cases}
    part = lambda i: [(s.split(":")[0], text[i][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in by_id[i].split(",") if s]
    assert part(23) == [("card", "378282246310005"), ("phone", "555 123 4567"), ("iban", "DE89 3704 0044 0532 0130 00")]
    assert part(24) == [("iban", "GB82WEST12345698765432")]
    assert pii.find(none).count() == 0


def test_pii_words_before_earlier_numbers(spark):
    """A word serves every span within 40 characters after it, whatever numbers stand between, and none further off."""
    texts = ["Phone: 555-123-4567 or 555-987-6543", "amex card (exp 12/26) 378282246310005", "phone 555 123 4567 " + "x" * 40 + " 555 987 6543", "555-123-4567 phone", "é😀 tel 1 555-123-4567, 555-987-6543, 555-222-3333, 555-444-5555"]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = lambda i, kind, *parts: ",".join(f"{kind}:{texts[i].index(x)}:{texts[i].index(x) + len(x)}" for x in parts)
    assert got[0] == found(0, "phone", "555-123-4567", "555-987-6543")
    assert got[1] == found(1, "card", "378282246310005")
    assert got[2] == found(2, "phone", "555 123 4567")
    assert got[3] == ""
    assert got[4] == found(4, "phone", "555-123-4567", "555-987-6543", "555-222-3333")


def test_pii_secrets(spark):
    """Keys need a word before them, a letter and a digit; words alone, plain words and far-off words give none."""
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [f'The token = "{key}" here', f"api_key: {key}", key, f"token {'x' * 41} {key}", "password " + "a" * 30, f"secret {key[:19]}", f"Bearer {key}, {key}"]
    got = {r["doc_id"]: (r["spans"], r["n_secret"]) for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    span = lambda i, at: f"secret:{at}:{at + 40}"
    assert got == {0: (span(0, 13), 1), 1: (span(1, 9), 1), 2: ("", 0), 3: ("", 0), 4: ("", 0), 5: ("", 0), 6: (span(6, 7), 1)}


def test_runs_merge():
    """Runs of any number and length, with keys that end in zero bytes and that repeat, against a dictionary."""
    import random

    r = random.Random(6)
    for _ in range(200):
        keys = [bytes([r.randrange(3)]) + bytes(dedup.KEY - 2) + bytes([r.randrange(3)]) for _ in range(r.randint(1, 60))]
        ids, known = [r.randrange(9) for _ in keys], [r.random() < 0.7 for _ in keys]
        ids[0], known[0] = np.iinfo(np.int64).max, True
        arrays = (np.array(keys, f"S{dedup.KEY}"), np.array(ids), np.array(known), np.ones(len(keys), np.int64))
        runs = dedup.natural_runs(arrays)
        assert all((run[0][1:] >= run[0][:-1]).all() for run in runs) and sum(len(run[0]) for run in runs) == len(keys)
        k, i, there, n = dedup.combined(dedup.merged(runs))
        by = defaultdict(list)
        for key, id_, ok in zip(keys, ids, known, strict=True):
            by[key.rstrip(b"\0")].append(id_ if ok else None)
        assert k.tolist() == sorted(by)
        for key, id_, ok, size in zip(k.tolist(), i.tolist(), there.tolist(), n.tolist(), strict=True):
            real = [x for x in by[key] if x is not None]
            assert size == len(by[key]) and ok == bool(real) and (not ok or id_ == min(real))


def test_every_key_comes_home(spark):
    """After the last round no key is at two nodes, whatever partitions it began in, and a hot key is one record a run."""
    rows = spark.range(20000).repartition(9).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else cast(id % 4000 as string) end as text")
    got = dedup.tree_merge(dedup.digests(rows), 6).collect()
    assert len(got) == len({bytes(r["key"]) for r in got}) == 1 + sum(any(i % 3 for i in range(k, 20000, 4000)) for k in range(4000))
    assert max(r["group_size"] for r in got) == 6667 and sum(r["group_size"] for r in got) == 20000


def test_dedup(docs, cases, none):
    groups = defaultdict(list)
    for c in cases:
        groups[re.sub(SPACE, " ", c[1] or "")].append(c[0])
    expected = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    for nodes in (1, 2, 13):
        same(dedup.exact_dedup(docs.repartition(7), nodes).collect(), expected)
    assert dedup.exact_dedup(none).count() == 0
    left = dedup.drop_copies(docs)
    assert left.columns == docs.columns
    same([(r["doc_id"], re.sub(SPACE, " ", r["text"] or "")) for r in left.collect()], {(e[1], t) for t, ids in groups.items() for e in expected if e[4] == hashlib.sha256(t.encode()).hexdigest()})


def test_very_long_texts(spark):
    """Texts of millions of characters: prose, one word again and again, and one word without end; each whole, in every operator."""
    import random

    r = random.Random(3)
    some = ["".join(r.choice("abdeinorstué") for _ in range(r.randint(2, 9))) for _ in range(50_000)]
    prose = " ".join(r.choice(some) for _ in range(1_600_000))
    assert len(prose.encode()) > 10_000_000
    texts = [prose, prose.replace(" ", "\n", 7) + " a@b.example.com", "spam " * 200_000, "x" * 1_000_000 + " 4111111111111111", "short text of a few words"]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(2).cache()
    by = lambda df: {x["doc_id"]: x for x in df.collect()}

    def repeats(w):
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        return len({i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)})

    base = by(quality.quality(docs))
    for i in (0, 2, 3, 4):
        w = words(texts[i])
        assert (base[i]["n_words"], base[i]["word_chars"], base[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), repeats(w) if i else 0)
    assert {i: x["lang_pred"] != "und" for i, x in by(langid.identify(docs)).items()} == dict.fromkeys(range(5), True)
    n = sorted(x["n_tokens"] for x in counts.lengths(docs).collect())
    assert n == sorted(len(counts.encoding("byte_bpe_50k.tiktoken").encode_ordinary(t)) for t in texts)
    assert {i: x["size"] for i, x in by(mixing.mix(docs)).items()} == {i: len(words(t)) for i, t in enumerate(texts)}
    near = by(simhash.near_dedup(docs))
    assert near[4]["fingerprint"] == f"{brute_fingerprint(texts[4]):016x}" and near[2]["fingerprint"] == f"{xxhash.xxh64_intdigest(b'spam spam spam', 42):016x}" and near[1]["component_id"] == 0
    t, made = Tokenizer.from_file(bpe.public_path("word_bpe_49k.json")), by(bpe.encode_texts(docs))
    for i in (0, 2, 4):
        ids = t.encode(texts[i], add_special_tokens=False).ids
        assert made[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    found = by(pii.find(docs))
    assert found[1]["spans"] == f"email:{len(texts[1]) - 15}:{len(texts[1])}" and found[3]["n_card"] == 1 and found[0]["n_spans"] == 0
    copies = by(dedup.exact_dedup(docs))
    assert all(copies[i]["text_sha256"] == hashlib.sha256(re.sub(SPACE, " ", x).encode()).hexdigest() for i, x in enumerate(texts))
    docs.unpersist()
