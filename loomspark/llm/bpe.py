"""Byte-pair encoding by backtracking, and decoding by an offset table.

For each word the longest token at every position comes from one pass of an Aho-Corasick automaton
over the reversed word. The encoder takes the longest token that may follow the last one and steps
back when none may: two tokens are compatible if no merge of lower rank than those that made them
would have joined their inner parts, which a table of pairs tells. The result is that of applying
the merges in order, in time linear in the word.

The token file is one of the ``tokenizers`` library: a BPE model with an end-of-word suffix behind
NFC, white space folding, lower case, a split pattern and the byte alphabet. Words are encoded once
per Python worker while they stay in a two-generation cache of bounded size.

Defined cases: null and empty texts have no tokens and decode to the empty text; a null doc_id is
passed on; rows that repeat give repeated rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that one generation of the cache holds, and pairs that the compatibility table remembers.
CACHE_WORDS = 150_000
CACHE_PAIRS = 1_000_000
#: Code points whose character classes are the same in all versions of Unicode that matter, and no odd white space.
STABLE = "\t-\r -~\xa1-\u0377\u0386-\u038a\u038e-\u03a1\u03a3-\u0482\u048a-\u0513\u2010-\u2027\u2030-\u205e\u20a0-\u20b5\u2100-\u214b\u2190-\u23e7\u2500-\u269c\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
#: Added to the code point of a word's last symbol: it stands for the symbol with the end-of-word suffix.
END = 0x1000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class BacktrackingEncoder:
    """Merges of one BPE model. Symbols are characters; token strings are unique."""

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]]):
        import ahocorasick

        self.ids, self.length = tokens, {i: len(t) for t, i in tokens.items()}
        self.rank = {}  # of the merge that makes a token; symbols come before every merge
        self.parts, self.pair = {}, {}
        for r, (a, b) in enumerate(merges):
            made = tokens[a + b]
            if made not in self.parts:
                self.parts[made], self.rank[made] = (tokens[a], tokens[b]), r
            self.pair[tokens[a], tokens[b]] = made, r
        self.shorter: dict[int, int | None] = {}
        for t, i in tokens.items():
            self.shorter[i] = next((tokens[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in tokens), None)
        self.automaton = ahocorasick.Automaton()
        # Nodes list their children in the order of arrival and are searched in it: tokens of early merges come first.
        for t in sorted(tokens, key=lambda t: self.rank.get(tokens[t], len(merges))):
            self.automaton.add_word(t[::-1], tokens[t])
        self.automaton.make_automaton()
        self.known: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether left and right stay apart when the merges are applied to their joined text."""
        at = (left, right)
        if (known := self.known.get(at)) is None:
            if len(self.known) >= CACHE_PAIRS:
                self.known.clear()
            known = self.known[at] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # Undo the later merge of the two again and again; a pair across the border that merges
        # before the limit would have taken one of the parts away.
        rank, parts, limit = self.rank, self.parts, float("inf")
        while True:
            joined = self.pair.get((a, b))
            if joined is not None and joined[1] < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            # Of equal ranks (the same token twice) the left one was merged first.
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                limit, b = rb + 0.5, parts[b][0]

    def encode(self, word: str) -> list[int]:
        n = len(word)
        longest: list[int | None] = [None] * (n + 1)
        for at, token in self.automaton.iter(word[::-1]):
            if longest[n - 1 - at] is None:
                longest[n - 1 - at] = token
        out: list[int] = []
        pos, token, dead, length, shorter = 0, longest[0], set(), self.length, self.shorter
        while pos < n:
            while token is not None:
                end = pos + length[token]
                if end not in dead and (not out or self.compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                pos = end
                token = longest[pos]
            elif not out:
                raise ValueError(f"no tokens for {word!r}")
            else:
                dead.add(pos)
                token = out.pop()
                pos -= length[token]
                token = shorter[token]
        return out


class WordBpe:
    """A tokenizer file with words that end in a suffix: texts to the bytes of 32-bit ids and back."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        cut = len(self.suffix)
        marked = lambda t: t[: -cut - 1] + chr(ord(t[-cut - 1]) + END) if t.endswith(self.suffix) else t
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = BacktrackingEncoder({marked(t): i for t, i in model["vocab"].items()}, [(marked(a), marked(b)) for a, b in merges])
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        self.stable_char = re.compile(f"[{STABLE}]").match
        self.stable_seen = {" "}
        self.blanks = re.compile(r"[^ \t\n\r]+").findall
        self.path, self.library = path, None
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self._offsets({**{i: t for t, i in model["vocab"].items()}, **{i: t for t, i in self.added.items()}})

    def _offsets(self, text_of: dict[int, str]) -> None:
        import numpy as np

        pieces = [(text_of.get(i, "") + " ").encode() for i in range(max(text_of) + 1)]
        self.table = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def unstable(self, text: str) -> bool:
        odd = set(text) - self.stable_seen
        if odd and all(map(self.stable_char, odd)):
            self.stable_seen |= odd
            return False
        return bool(odd)

    def symbols(self, symbols: str) -> bytes:
        """The ids of one piece in the byte alphabet, kept in a cache of its own: many words share pieces."""
        got = self.pieces.get(symbols)
        if got is None:
            got = b"".join([i.to_bytes(4, "little") for i in self.bpe.encode(symbols[:-1] + chr(ord(symbols[-1]) + END))])
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            if len(symbols) <= 64:
                self.pieces[symbols] = got
        return got

    def word(self, word: str) -> bytes:
        """The ids of one word between white space, kept in the cache."""
        got = self.old.get(word)
        if got is None and self.unstable(word):
            got = b"".join(self.rare(word))
        elif got is None:
            # Lower case goes by single characters: no final sigma.
            pieces = self.split(unicodedata.normalize("NFC", word).replace("Σ", "σ").lower())
            got = b"".join([self.symbols(p.encode().decode("latin-1").translate(self.letters)) for p in pieces])
        if len(self.new) >= CACHE_WORDS:
            self.new, self.old = {}, self.new
        if len(word) <= 64:
            self.new[word] = got
        return got

    def rare(self, text: str) -> list[bytes]:
        """The ids of a word with characters that versions of Unicode class differently: the library splits it."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        return [self.symbols(piece) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append(self.added[part].to_bytes(4, "little"))
            else:
                # No piece crosses white space; where there are odd characters only the plain blanks are sure to be that.
                for w in self.blanks(part) if self.unstable(part) else part.split():
                    got = self.new.get(w)
                    out.append(self.word(w) if got is None else got)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8: tokens joined by a space, special ones too."""
        import numpy as np

        out, ids = [], np.frombuffer(ids, "<u4")
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)]
            sizes = self.sizes[some]
            before = np.cumsum(sizes) - sizes
            out.append(self.table[np.repeat(self.starts[some] - before, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def public_path(name: str) -> str:
    """Where this machine has a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, name: str = "word_bpe_49k.json", ids: bool = False, decoded: bool = False, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns carry of docs, n_tokens, ids_sha256, decoded_sha256 of each row of docs (text).

    ids adds the ids (little-endian unsigned 32-bit integers), decoded the decoded text.
    """
    extra = ["ids binary"] * ids + ["decoded string"] * decoded
    kinds = ", ".join(["n_tokens long, ids_sha256 string, decoded_sha256 string", *extra])

    @F.pandas_udf(kinds)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = tokenizer(public_path(name))
        for batch in texts:
            rows = []
            for text in batch:
                made = t.encode(text)
                back = t.decode(made)
                row = (len(made) // 4, hashlib.sha256(made).hexdigest(), hashlib.sha256(back).hexdigest())
                rows.append(row + (made,) * ids + (back.decode(),) * decoded)
            yield pd.DataFrame(rows, columns=[k.split()[0] for k in kinds.split(", ")])

    return docs.select(*carry, run("text").alias("r")).select(*carry, "r.*")
