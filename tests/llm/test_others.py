"""Chat formatting, templates, URL filters and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from loomspark.llm import chat, template, urls
from loomspark.llm.sql import ORACLE
from loomspark.llm.template import compile_template, fold, parse


def render(source, **variables):
    return "".join(t for t, _ in compile_template(source)(**variables))


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"), ("{{ 'x' ~ 2 }}{# no #}", "x2"), ("{% if n > 2 and not z %}big{% elif n %}small{% else %}none{% endif %}", "big"),
        ("{% for x in xs %}{{ loop.index }}{{ x.k | upper }}{% if not loop.last %},{% endif %}{% endfor %}", "1A,2B"), ("{% set y = xs[1].k %}{{ y | default('?') }}{{ q | default('?') }}", "b?"),
        ("  {%- if true -%}  x  {%- endif -%}  ", "x"), ("{{ 'a\\n\\'' }}", "a\n'"), ("{{ xs | length }}", "2"), ("{{ none }}{{ true }}", "true"), ("{{ (1 - 2) * 3 }}", "-3"),
    ],
)
def test_template(source, expected):
    assert render(source, n=3, z=None, xs=[{"k": "a"}, {"k": "b"}]) == expected


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ open('f') }}", "{{ ''.join }}", "{{ f() }}", "{% import os %}", "{{ x | nofilter }}", "{% for x in y %}", "{{ 'a' * 99999999 }}", "{{ 1 +", "{{ 'a' % 3 }}"])
def test_template_sandbox(source):
    with pytest.raises((template.TemplateError, AttributeError)) if "{{ 1 +" not in source else pytest.raises(AssertionError):
        assert render(source, x=object(), f=len) == source + "!"


def test_folding():
    assert fold(parse("{% if 1 > 2 %}a{% else %}b{{ 2 * 3 }}{% endif %}c")) == ("block", ("text", "b6c"))


def test_escape_reversible():
    r = random.Random(3)
    for _ in range(2000):
        s = "".join(r.choice("<[\\n\n|>s/] a") for _ in range(r.randint(0, 12)))
        assert template.unescape(template.escape(s)) == s and template.unescape(template.escape_line(s)) == s
        assert "\n" not in template.escape_line(s) and not re.search(r"[<\[](?!\\)", template.escape(s))


def test_chat(spark):
    r = random.Random(2)
    noise = lambda: "".join(r.choice(["</s>", "<|end|>\n", "<|turn|>", "[INST]", "\\", "\n", "é😀", "word "]) for _ in range(r.randint(0, 9)))
    rows = [(c, t, r.choice(["user", "assistant", "system", "od<d\nrole", None]), r.choice([noise(), noise(), None]), "x") for c in [1, 2, None, 5] for t in range(r.randint(1, 9))]
    rows += [(7, 0, "assistant", "b", "x"), (7, 0, "assistant", "a", "x"), (7, None, "user", "first", "x"), (7, 0, "assistant", "a", "x")] + [(8, t, "assistant", f"turn {t} ", "x") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    got = {x["conv_id"]: x for x in chat.format_digests(chat.with_probe(df)).collect()}
    says = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", says, ""), (-7, 1, "assistant", says, "")]
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), (role is not None, role or ""), (text is not None, text or "")))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns = [(role[1], text[1]) for _, role, text in sorted(turns)]
        loss = "".join(t for role, t in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        formatted, spans = chat.format_messages([{"role": a, "text": b} for a, b in turns])
        assert tuple(got[c])[1:] == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss), len(formatted))
        assert template.unescape("".join(formatted[a:b] for a, b in spans)) == loss
    assert chat.format_digests(df.limit(0)).count() == 0


PAGES = "page_id long, url string, html string, host string, rank double"


def brute_verdicts(pages, rounds=300):
    parts = []
    for page_id, url, html, *_ in pages:
        _, there, rest = (url or "").partition("://")
        host = re.match(r"[^/?#]*", rest)[0] if there else ""
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0] if there else ""
        fits = [(len(r), r, k) for k, r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        parts.append((page_id, host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None, html))
    edges = Counter((p[1], d.lower()) for p in parts for d in re.findall(urls.LINK, p[5] or "") if p[1] and d.lower() != p[1])
    allowed, blocked, n = {}, {}, {}
    for _, host, _, _, verdict, _ in parts:
        n[host] = n.get(host, 0) + 1
        for d, v in ((allowed, "allow"), (blocked, "block")):
            d[host] = d.get(host, 0) + (verdict == v)
    good = [h for h in n if h and allowed[h] > blocked[h]]
    bad = [h for h in n if h and not allowed[h] > blocked[h] and 2 * blocked[h] > n[h]]

    def always(host):
        """What rules say of every url of a host that has no page."""
        said = None
        for kind, r in sorted(urls.RULES, key=lambda x: len(x[1])):
            name, _, rest = r.partition("/")
            if host == name or host.endswith("." + name):
                said = kind if not rest else None if said != kind else said
        return said

    unseen = {d for _, d in edges} - set(n)
    good, bad = good + [h for h in unseen if always(h) == "allow"], bad + [h for h in unseen if always(h) == "block"]

    def spread(seeds, links):
        """Power iteration; what is held where no link leads on goes back to the seeds."""
        seed, out = {h: 1 / len(seeds) for h in seeds}, Counter()
        for (a, _), k in links.items():
            out[a] += k
        rank = dict(seed)
        for _ in range(rounds):
            idle = sum(x for h, x in rank.items() if not out[h])
            new = {h: (0.15 + 0.85 * idle) * s for h, s in seed.items()}
            for (a, b), k in links.items():
                if a in rank:
                    new[b] = new.get(b, 0) + 0.85 * rank[a] * k / out[a]
            rank = new
        return rank

    trust, distrust = spread(good, edges), spread(bad, Counter({(b, a): k for (a, b), k in edges.items()}))
    host_bad = {h for h, d in distrust.items() if d * len(bad) >= urls.MIN_SCORE and d > trust.get(h, 0)}
    return [(p[0], p[1], p[2], p[3], p[4] or ("block" if p[1] in host_bad else "allow")) for p in parts]


def by_sql(pages):
    """The query's SQL over pages given as rows."""
    table = pd.DataFrame([p[:3] for p in pages], columns=["page_id", "url", "html"]).astype({"page_id": "Int64", "url": object, "html": object})
    con = duckdb.connect()
    con.register("pages", table)
    return [tuple(r) for r in con.execute(f"select page_id, host, path, rule, verdict from ({ORACLE['op6_urls']})").fetchall()]


def test_urls_of_a_random_web(spark):
    """Hosts, some with pages, some blocked, some trusted, some without a link: operator, power iteration and SQL agree."""
    r = random.Random(8)
    names = [f"h{i}.{r.choice(['net', 'org', 'com', 'io', 'com', 'io'])}" for i in range(60)]
    pages = []
    for i in range(150):
        to = [r.choice(names[: r.choice([5, 60])]) for _ in range(r.choice([0, 1, 1, 3, 6]))]
        pages.append((i, f"https://{r.choice(names[:50])}/{r.choice(['fr', 'en', 'x'])}/{i}", "".join(f'<a href="//{h}/y">y</a>' for h in to), None, 1.0))
    got = [tuple(x) for x in urls.judge(spark.createDataFrame(pages, PAGES)).collect()]
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(brute_verdicts(pages), key=key) == sorted(by_sql(pages), key=key)
    by_rank = [x for x in got if x[3] is None]
    assert {x[4] for x in by_rank} == {"block", "allow"}


def test_urls(spark):
    link = lambda *hosts: "".join(f'<a HREF="http://{h}/x">x</a> <img src=//{h}>' for h in hosts)
    pages = [
        (1, "http://A.example.net/en/1", link("evil.example.com"), None, 1.0), (2, "https://b.example.net/x?y://z", link("spam.example.com"), None, 1.0), (3, "http://spam.example.com/q#f", link("b.example.net", "good.example.org"), None, 1.0),
        (4, "http://good.example.org/fr/1", link("friend.example.com"), None, 1.0), (5, "http://friend.example.com/ok", link("ok.example.com"), None, 1.0), (6, "http://friend.example.com/de/ok", None, None, 1.0),
        (7, None, link("b.example.net"), None, 1.0), (8, "no scheme", "", None, 1.0), (9, "http://evil.example.com", link("b.example.net"), None, 1.0), (10, "http://x.net", "", None, 1.0), (11, "http://notnet/", "", None, 1.0),
        (12, "http://far.example.com/", link("evil.example.com"), None, 1.0), (5, "http://friend.example.com/ok", link("ok.example.com"), None, 1.0), (None, "ftp://net/en", "", None, 1.0), (13, "x://example.net/en/a\nb", "", None, 1.0),
    ]
    df = spark.createDataFrame(pages, PAGES)
    got = [tuple(r) for r in urls.judge(df).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute_verdicts(pages), key=key)
    assert sorted(by_sql(pages), key=key) == sorted(got, key=key)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[3] == "block" and verdict[5] == "allow" and verdict[12] == "block"
    assert urls.judge(df.limit(0)).count() == 0


def test_urls_at_any_number_of_seeds(spark):
    """A host that links to one of many blocked hosts is blocked, however many there are."""
    for n in (1, 3000):
        pages = [(i, f"http://h{i}.x.net/", "", None, 1.0) for i in range(n)] + [(-1, "http://fan.example.com/", '<a href="http://h0.x.net/">', None, 1.0), (-2, "http://other.example.com/", '<a href="/in">', None, 1.0)]
        got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(pages, PAGES)).where("page_id < 0").collect()}
        assert got == {-1: "block", -2: "allow"}


def test_urls_along_a_chain(spark):
    """Ranks are those of an exact solution, and hosts further than eight links from a blocked one are judged by them."""
    import numpy as np

    n = 40
    pages = [(0, "http://bad.x.net/", "", None, 1.0)] + [(i, f"http://c{i}.example.com/", f'<a href="http://{"bad.x.net" if i == 1 else f"c{i - 1}.example.com"}/">', None, 1.0) for i in range(1, n)]
    df = spark.createDataFrame(pages, PAGES)
    parts = df.select(urls.host_of(df["url"]).alias("host"), "html").withColumn("verdict", urls.rule_of(urls.F.col("host"), urls.F.lit("/"))[1])
    back = np.diag(np.ones(n - 1), -1)  # distrust goes from host i - 1 to host i
    exact = np.linalg.solve(np.eye(n) - 0.85 * back, 0.15 * np.eye(n)[0])
    exact /= exact.sum()  # what the last host holds goes back to the one seed
    got = {r["host"]: r["distrust"] for r in urls.host_scores(parts).collect()}
    assert all(abs(got.get("bad.x.net" if i == 0 else f"c{i}.example.com", 0) - exact[i]) <= urls.TOLERANCE for i in range(n))
    verdict = {r["page_id"]: r["verdict"] for r in urls.judge(df).collect()}
    assert verdict == {i: "block" if exact[i] >= urls.MIN_SCORE else "allow" for i in range(n)} and verdict[30] == "block" != verdict[31]


def test_urls_of_blocked_hosts_without_pages(spark):
    """A host that links to a blocked host nobody crawled is blocked; one whose rules depend on the path is no seed."""
    link = lambda h: f'<a href="http://{h}/x">x</a>'
    pages = [(1, "http://fan.example.com/", link("bad.x.net"), None, 1.0), (2, "http://other.example.com/", link("fine.example.com"), None, 1.0), (3, "http://third.example.com/", link("a.example.net"), None, 1.0), (4, "http://farther.example.com/", link("fan.example.com"), None, 1.0)]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    hosts = spark.createDataFrame([("bad.x.net",), ("a.example.net",), ("x.org",), ("example.com",)], "host string")
    assert [r[0] for r in hosts.select(urls.rule_of_all(urls.F.col("host"))).collect()] == ["block", None, None, None]
    rules = (("block", "com/a/"), ("allow", "good.com/"), ("block", "good.com/b/"), ("allow", "org/"), ("allow", "org/c/"), ("block", "bad.org/"))
    hosts = spark.createDataFrame([("good.com",), ("org",), ("x.bad.org",), ("com",)], "host string")
    assert [r[0] for r in hosts.select(urls.rule_of_all(urls.F.col("host"), rules)).collect()] == [None, "allow", "block", None]


def brute_pipeline(rows):
    """The five stages in plain Python over (doc_id, text, lang, source, n_chars); the rows that run() returns."""
    import test_documents as brute
    from tokenizers import Tokenizer

    from loomspark.llm import bpe, mixing, quality

    key = lambda i: (i is None, i or 0)
    drop = str.maketrans("", "", quality.DROPPED)
    lines_of = lambda text: [(k, x, x.lower().translate(drop)) for k, x in enumerate(text.split("\n")) if brute.words(x)]
    texts_of, first, hosts = {}, {}, {}
    for doc_id, text, _, source, _ in rows:
        for _, _, line in lines_of(text or ""):
            at = (source, line)
            texts_of.setdefault(at, set()).add(text)
            first[at] = min(first.get(at, key(doc_id)), key(doc_id))
            hosts.setdefault(source, set()).add(text)
    frequent = {at for at, t in texts_of.items() if len(t) > quality.MAX_DOCS and len(t) > min(quality.MAX_DOC_SHARE * len(hosts[at[0]]), quality.ENOUGH_DOCS)}
    clean = []
    for doc_id, text, lang, source, n_chars in rows:
        w = brute.words(text)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
        gone = [(k, x) for k, x, line in lines_of(text or "") if (source, line) in frequent and first[source, line] != key(doc_id)]
        n = sum(len(brute.words(x)) for _, x in gone)
        if len(w) < 20 or 100 * len(again) > 30 * len(w) or (n and (len(w) - n < quality.MIN_WORDS or len(w) - n < quality.MIN_SHARE * len(w))):
            continue
        places = {k for k, _ in gone}
        less = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in places) if gone else text
        clean.append((doc_id, less, lang, source, n_chars if n_chars is None else n_chars - len(text) + len(less)))
    groups = {}
    for row in clean:
        groups.setdefault(re.sub(brute.SPACE, " ", row[1]), []).append(row)
    alone = [min(g, key=lambda r: key(r[0])) for g in groups.values()]
    fps = [brute.brute_fingerprint(r[1]) for r in alone]
    component = brute.brute_components(fps, [r[0] for r in alone])
    stays = {r[0] for r, f in zip(alone, fps, strict=True) if r[0] == component[f]}
    apart = [r for r in alone if r[0] in stays]
    sizes = Counter()
    for r in apart:
        sizes[r[3]] += len(brute.words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = brute.filled(dict(sizes), {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}, mixing.CAP)
    t, out = Tokenizer.from_file(bpe.public_path("word_bpe_49k.json")), []
    for s in order:
        u = int(hashlib.md5((f"{mixing.SEED}:{s}" if s is not None else mixing.SEED).encode()).hexdigest()[:12], 16) / 2**48
        e = target[s] / sizes[s] if sizes[s] else 0
        for k, r in enumerate(sorted((r for r in apart if r[3] == s), key=lambda r: (len(brute.words(r[1])), key(r[0]))), 1):
            ids = t.encode(r[1], add_special_tokens=False).ids
            raw, back = b"".join(i.to_bytes(4, "little") for i in ids), t.decode(ids, skip_special_tokens=False)
            copies = int(k * e + u) - int((k - 1) * e + u)
            out += [(r[0], r[2], r[3], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), raw)] * copies
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    """Frequent lines, short and repeating texts, exact and near copies, sources of uneven sizes, nulls."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abdeinorstué") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(120):
        source = ("hot", "hot", "b", "c", None)[i % 5]
        body = prose(r.randint(15, 120))
        menu = f"Home | News | About us {'' if i % 2 else ' !'}\n" if source == "hot" else ""
        rows.append((i, menu + body + ("\nAll rights reserved by the owners of this site" if source == "hot" and i % 3 else ""), ("en", "fr", None)[i % 3], source))
    rows += [(200 + i, rows[i][1].replace(" ", "  "), "en", rows[i][3]) for i in range(0, 30, 3)]
    rows += [(300 + i, rows[i][1] + " x", "en", rows[i][3]) for i in range(0, 60, 7)]
    rows += [(400, "menu\n" + "\n".join(["Home | News | About us"] * 8), "en", "hot"), (401, f"{prose(6)} " * 9, "en", "b"), (402, None, "en", "b"), (None, prose(40), None, None), (403, "Home | News | About us\n" + prose(22), "en", "c")]
    rows = [(*x, len(x[1] or "")) for x in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    expected = brute_pipeline(rows)
    got = [(x["doc_id"], x["lang"], x["source"], x["n_tokens"], x["ids_sha256"], x["decoded_sha256"], bytes(x["ids"])) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(expected) and len(got) > 100


def test_pipeline(spark, docs, tmp_path):
    """Every stage against what it must keep, and run() against the stages one by one."""
    import test_documents as brute

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    n = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, kept = kept, stage(spark, kept, str(tmp_path)).cache()
        n.append(kept.count())
        if k < 4:
            assert kept.columns == docs.columns
            assert kept.exceptAll(before).count() == 0 or k == 3
        if k == 0:
            texts = {r["text"] for r in kept.collect()}
            assert all(len(brute.words(t)) >= 20 for t in texts)
        if k == 1:
            assert len({re.sub(brute.SPACE, " ", r["text"]) for r in kept.collect()}) == n[-1]
        if k == 2:
            fps = [brute.brute_fingerprint(r["text"]) for r in kept.collect()]
            assert all((a ^ b).bit_count() > 2 for i, a in enumerate(fps) for b in fps[:i])
            near = {r["doc_id"] for r in kept.collect()}
            assert 6 in near and 10 not in near
    assert n[3] == n[4] > 0
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, kept.collect()))


def test_pipeline_of_nothing(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
