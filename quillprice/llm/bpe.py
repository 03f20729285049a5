"""BPE encoding and decoding by a prefix-sharing trie traversal.

Byte pair encoding has this property: if the encoding of a string ends in token
t, the rest of the encoding is that of the string without t, and t is the only
token for which the pair (last token before it, t) would itself stay unmerged.
So every prefix of a word has one last token, found from those of its shorter
prefixes. The distinct new words of a batch make a trie; one depth-first walk
keeps the last tokens along the current path, so a prefix that many words share
is worked out once, and a word's tokens are read off backwards along its path.

The file is one of the ``tokenizers`` library with byte-level symbols and a suffix
for word ends; it is read on the driver and broadcast. Text is cut into words as
the file says: special tokens first, then NFC, white space runs as one blank,
lower case character by character, and the split pattern.

Null text counts as empty and has no tokens; the digest of no ids is that of the
empty string. Texts are taken in pieces that end at white space, so a very long
one is never held as a whole list of tokens by the digests. Repeated rows give
repeated rows; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillprice.llm.common import text_or_empty

PIECE = 1 << 18
#: Words kept with their ids, words per trie, and token pairs kept, in each Python worker.
CACHED_WORDS, TRIE_WORDS, CACHED_PAIRS = 250_000, 20_000, 300_000
_NEVER = 1 << 30


def default_path() -> str:
    """The public word-end vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _ranges(chars) -> str:
    """The body of a character class of the given code points."""
    out, codes = [], sorted(chars)
    start = 0
    for k in range(1, len(codes) + 1):
        if k == len(codes) or codes[k] != codes[k - 1] + 1:
            out.append(f"\\U{codes[start]:08x}-\\U{codes[k - 1]:08x}")
            start = k
    return "".join(out)


def unicode_tables() -> dict:
    """Letters and numbers as character class bodies, and lower case that Python lacks.

    The tokenizers library may follow a later Unicode than this Python; it is asked
    about the code points that Python does not know.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers
    kinds: dict[str, list[int]] = {"L": [], "N": [], "Cn": []}
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN":
            kinds[kind[0]].append(c)
        elif kind == "Cn":
            kinds["Cn"].append(c)
    unknown = "".join(map(chr, kinds["Cn"]))
    lower = {}
    for i in range(0, len(unknown), 20_000):
        part = unknown[i:i + 20_000]
        for kind in "LN":
            others = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed").pre_tokenize_str(part)
            kinds[kind] += map(ord, set(part) - set(chain.from_iterable(x for x, _ in others)))
        small = normalizers.Lowercase().normalize_str(part)
        if small != part:
            lower |= {c: normalizers.Lowercase().normalize_str(c) for c in part if c not in small}
    return {"letters": _ranges(kinds["L"]), "numbers": _ranges(kinds["N"]), "lower": lower}


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """One vocabulary; ``spec`` is the parsed file, ``unicode`` the ``unicode_tables``."""

    def __init__(self, spec: dict, unicode: dict):
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]:
            raise ValueError("not a vocabulary with word ends in lower case")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self.numbers = {i: str(i) for i in self.tokens}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        #: by pair of ids: rank of their merge; by id: rank, left and right part of the merge that makes it
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        self._pairs: dict[int, bool] = {}
        self._steps: dict[str, tuple[str, tuple, tuple]] = {}
        merges = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        ids = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        for r, (a, b, _) in enumerate(ids):
            self.rank.setdefault((a, b), r)
        base = {self.vocab[s + end] for s in _byte_symbols() for end in ("", self.suffix) if s + end in self.vocab}
        for r, (a, b, t) in enumerate(ids):
            reached = all(x in base or x in self.made for x in (a, b))
            if reached and t not in self.made and self._apart(a, b, r):
                self.made[t] = (r, a, b)
        #: tokens that encode to themselves, within words and at their ends
        usable = base | self.made.keys()
        self.inner = {t: i for t, i in self.vocab.items() if i in usable and not t.endswith(self.suffix)}
        self.last = {t[:-len(self.suffix)]: i for t, i in self.vocab.items() if i in usable and t.endswith(self.suffix)}
        self.prefixes = {t[:k] for t in chain(self.inner, self.last) for k in range(1, len(t))}
        self.length = {i: len(t) for t, i in self.inner.items()} | {i: len(t) for t, i in self.last.items()}
        self.bytes = _byte_symbols()
        self.words: dict[str, tuple[int, ...]] = {}
        letters, numbers = unicode["letters"], unicode["numbers"]
        #: lower case is taken character by character: no final form of sigma
        self._lower = str.maketrans({"Σ": "σ"} | unicode["lower"])
        blank = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
        ends = "'(?:[stmd]|re|ve|ll)"
        self._cut = re.compile(f"[{letters}]+|{ends}|[{numbers}]|[^{blank}{letters}{numbers}]+")
        self._cut_ascii = re.compile(f"[a-z]+|{ends}|[0-9]|[^\\t-\\r a-z0-9]+")

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether tokens a, b side by side stay unmerged by the merges before ``limit``.

        Going back in time, the later-made of the two pieces at the seam is taken
        apart. The pieces at the seam would merge if their merge comes before both
        become part of something larger; of equal merges the left one goes first.
        """
        until_a = until_b = limit
        while True:
            r = self.rank.get((a, b), _NEVER)
            if r < until_a and r <= until_b and r < limit:
                return False
            made_a, made_b = self.made.get(a), self.made.get(b)
            if made_b and (not made_a or made_b[0] >= made_a[0]):
                until_b, b = made_b[0], made_b[1]
            elif made_a:
                until_a, a = made_a[0], made_a[2]
            else:
                return True

    def _step(self, ends: str) -> tuple[str, tuple, tuple]:
        """What may end where a path ends in ``ends``: (open prefix, inner tokens, word-end tokens).

        The open prefix is the longest end of the path that begins some token. Any
        token that ends one symbol later lies within it and that symbol, so it is
        all of the path that the next step needs. Tokens come as (size, id),
        longest first.
        """
        suffixes = [ends[i:] for i in range(len(ends))]
        step = (next((x for x in suffixes if x in self.prefixes), ""),
                tuple((len(x), self.inner[x]) for x in suffixes if x in self.inner),
                tuple((len(x), self.last[x]) for x in suffixes if x in self.last))
        if len(self._steps) >= CACHED_PAIRS:
            self._steps.clear()
        self._steps[ends] = step
        return step

    def _last_token(self, choices, lasts: list[int], n: int) -> int:
        """The last token of the encoding of the first ``n`` symbols; ``lasts[k]`` is that of the first k."""
        pairs = self._pairs
        for size, token in choices:
            if size == n:
                return token
            before = lasts[n - size]
            known = pairs.get(before << 20 | token)
            if known is None:
                if len(pairs) >= CACHED_PAIRS:
                    pairs.clear()
                known = pairs[before << 20 | token] = self._apart(before, token, _NEVER)
            if known:
                return token
        raise ValueError("no token ends here")

    def learn(self, words) -> None:
        """Encode distinct new words by one depth-first walk of their trie.

        Sorted words name the leaves of the trie in depth-first order. The walk
        keeps the states along the current path; what two neighbours share of
        their paths is a path through common nodes and is kept.
        """
        symbols = self.bytes
        leaves = sorted((w if w.isascii() and w.isprintable() else
                         "".join(map(symbols.__getitem__, w.encode("utf-8", "surrogatepass"))), w) for w in words)
        steps, lasts, states, above = self._steps, [0], [""], ""
        for path, word in leaves:
            n = len(path)
            shared, most = 0, min(n - 1, len(above) - 1)
            while shared < most and path[shared] == above[shared]:
                shared += 1
            del lasts[shared + 1:], states[shared + 1:]
            for k in range(shared, n - 1):
                ends = states[k] + path[k]
                state, inner, _ = steps.get(ends) or self._step(ends)
                lasts.append(self._last_token(inner, lasts, k + 1))
                states.append(state)
            above = path
            ends = states[n - 1] + path[n - 1]
            token, k, ids = self._last_token((steps.get(ends) or self._step(ends))[2], lasts, n), n, []
            while True:
                ids.append(token)
                k -= self.length[token]
                if not k:
                    break
                token = lasts[k]
            ids.reverse()
            self.words[word] = tuple(ids)

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return self._cut_ascii.findall(text.lower())
        if _BEYOND_LATIN.search(text):
            from tokenizers import normalizers
            text = normalizers.NFC().normalize_str(text).translate(self._lower)
        return self._cut.findall(text.lower())

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text; their new words share a trie."""
        cut = []
        for text in texts:
            parts = self._special.split(text) if self._special and "<" in text else [text]
            cut.append([[part] if part in self.special else self.split(part) for part in parts])
        distinct = set(chain.from_iterable(chain.from_iterable(cut))) - self.special.keys()
        new = distinct - self.words.keys()
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = distinct
        new = list(new)
        for i in range(0, len(new), TRIE_WORDS):
            self.learn(new[i:i + TRIE_WORDS])
        known = self.words
        return [list(chain.from_iterable(
            (self.special[words[0]],) if len(words) == 1 and words[0] in self.special
            else chain.from_iterable(map(known.__getitem__, words)) for words in found)) for found in cut]

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        return list(chain.from_iterable(ids for _, ids in self.encode_pieces([text])))

    def encode_pieces(self, texts):
        """Yield (position of the text, ids of its next piece), in order, within bounded memory."""
        group, held = [], 0
        for at, text in enumerate(texts):
            for piece in pieces(text):
                group.append((at, piece))
                held += len(piece)
                if held >= 4 * PIECE:
                    yield from zip([k for k, _ in group], self.encode_many([x for _, x in group]))
                    group, held = [], 0
        if group:
            yield from zip([k for k, _ in group], self.encode_many([x for _, x in group]))

    def decode(self, ids) -> str:
        """The tokens joined by blanks: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def pieces(text: str, size: int = PIECE):
    """The text in pieces that end before ASCII white space, which no token spans."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            cut = _BLANK.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


_BLANK = re.compile("[ \t\n\r]")
#: Below U+0300 every text is in NFC and Python's lower case is that of each character.
_BEYOND_LATIN = re.compile("[\u0300-\U0010ffff]")
_loaded: dict[str, WordBpe] = {}


def _shared(spark, path: str | None):
    """A function that gives each Python worker the vocabulary, built once there."""
    with open(path or default_path(), encoding="utf-8") as f:
        raw = f.read()
    shared, key = spark.sparkContext.broadcast((raw, unicode_tables())), hashlib.md5(raw.encode()).hexdigest()

    def get() -> WordBpe:
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = WordBpe(json.loads(shared.value[0]), shared.value[1])
        return _loaded[key]

    return get


def encode(docs: DataFrame, path: str | None = None, name: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text."""
    get = _shared(docs.sparkSession, path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        out: list[list[int]] = [[] for _ in texts]
        for at, found in get().encode_pieces(texts):
            out[at] += found
        return pd.Series(out, dtype=object)

    return docs.withColumn(name, ids(text_or_empty()))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for; null ids give null."""
    get = _shared(docs.sparkSession, path)

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        bpe = get()
        return pd.Series([None if x is None else bpe.decode(x) for x in column], dtype=object)

    return docs.withColumn(name, text(ids))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the encoding of each whole text and its decoding."""
    get = _shared(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        bpe = get()
        rows = [[0, hashlib.sha256(), hashlib.sha256()] for _ in texts]
        for at, ids in bpe.encode_pieces(texts):
            if ids:
                row = rows[at]
                gap = " " if row[0] else ""
                row[1].update((gap + " ".join(map(bpe.numbers.__getitem__, ids))).encode())
                row[2].update((gap + bpe.decode(ids)).encode())
                row[0] += len(ids)
        rows = [(n, left.hexdigest(), right.hexdigest()) for n, left, right in rows]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digest(text_or_empty()).alias("d")).select("doc_id", "d.*")
