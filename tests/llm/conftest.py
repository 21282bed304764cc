import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp long, size long, copies long, host string, row long"


def rows():
    """Texts with every case that the operators define, and columns whose names clash with theirs."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abdeinorstué") for _ in range(r.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, loop = prose(60), prose(9)
    near = base.split()
    near[30] = "changed"
    texts = [
        None, "", "   ", "\n\t", "one", "Two words", base, base, base.replace(" ", "  \t"), " ".join(near), base.replace("a", "A"), (loop + " ") * 12, prose(19), prose(20), prose(3000),
        "line one\nline one\n\n  \nline two\nline one", "#$% ||| <b>&</b> " * 9, "%%% 123 ### \x0b\x0c", "\ufeffé́ ẞ İ ΟΔΟΣ 日本語 😀" * 3, "x" * 5000, "1" * 5000, "a@" * 500,
        "mail a.b@c-d.example.com, 10.0.0.255 1.2.3.4.5 300.1.1.1 4111 1111 1111 1111 and +1 (555) 123-4567.", "card number 378282246310005, phone 555 123 4567, IBAN DE89 3704 0044 0532 0130 00 ok",
        "GB82WEST12345698765432 and GB82WEST12345698765433, 378282246310005", "<|endoftext|>it's <|startoftext|> They'LL </s>[INST]",
    ]
    texts += [prose(r.randint(1, 80)) for _ in range(25)] + [f"shared boilerplate line of the host\n{prose(30)}" for _ in range(25)] + ["shared boilerplate line of the host\n" + prose(3)]
    out = [(i, t, ("en", "fr", None)[i % 3], ("hot", "hot", "b", None)[i % 4], len(t or ""), False, 7, 7, 7, "h", 7) for i, t in enumerate(texts)]
    return out + [out[6], (None, "no id here", "en", "b", 3, False, 7, 7, 7, "h", 7), (None, None, None, None, None, None, None, None, None, None, None), (3, "another text of id three", "fr", "b", 1, False, 7, 7, 7, "h", 7)]


@pytest.fixture(scope="session")
def cases():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, cases):
    return spark.createDataFrame(cases, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
