"""Byte-level BPE by tries: the last token of every prefix, found once for all words that share the prefix."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of new words whose trie is built at a time, and words whose ids a worker remembers.
TRIE, REMEMBERED = 1 << 20, 200_000

#: Words taken from a long text at a time, and bytes of ids that are handed over at a time.
WORDS, HANDED = 1 << 16, 1 << 25

#: Pairs of tokens about which a worker remembers whether they stay apart.
PAIRS = 1 << 20

_WORD, _FINAL = -1, -1  # keys beside the bytes: the word that ends at a node, the token that begins at one

# The classes of characters in the pattern for words.
_CONTRACTED = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACE = r"\t-\r \x85\xa0"
_SPACES = _SPACE + r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"


# Code points that the pattern's Unicode, 16.0, does not assign and later versions may call letters or numbers.
_UNASSIGNED = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 "
    "16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
    "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
)


def _later() -> str:
    """The unassigned code points as part of a character class."""
    return "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in _UNASSIGNED.split())


def _pattern(letter: str, number: str, space: str) -> str:
    return (
        rf"{_CONTRACTED}| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


_LATIN = re.compile(_pattern(_LETTER, _NUMBER, _SPACE))
_ANY = regex.compile(_pattern(rf"[\p{{L}}--[{_later()}]]", rf"[\p{{N}}--[{_later()}]]", _SPACES), regex.V1)
_BEYOND_LATIN = re.compile(r"[^\x00-\xff]")


class VocabularyError(ValueError):
    """A tokenizer file that is not plain byte-level BPE."""


def words_of(text: str) -> Iterator[list[str]]:
    """The words that are merged each alone, in order, some at a time."""
    pattern = _ANY if _BEYOND_LATIN.search(text) else _LATIN
    if len(text) < WORDS:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while some := list(islice(found, WORDS)):
        yield some


def _byte_of_letter() -> dict[str, int]:
    """The byte of each letter in a vocabulary: visible letters stand for themselves, others for U+0100 and on."""
    visible = {b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, the merge that makes each, and which tokens may stand next to each other.

    Each merge makes a token of its own, from tokens of earlier merges, so merges happen in the order
    of their rank. The encoding of a text then ends, for each of its prefixes, in the one token
    that is a suffix of the prefix and stays apart from the last token of what is before it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        special = any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if model.get("type", "BPE") != "BPE" or not plain or odd or special or spec.get("normalizer"):
            raise VocabularyError(f"{path} is not plain byte-level BPE")
        byte = _byte_of_letter()
        ids = model["vocab"]
        self.bytes = {i: bytes(byte[c] for c in t) for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in added}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made, a, b = ids[left + right], ids[left], ids[right]
            if made in self.rank or any(len(self.bytes[x]) > 1 and x not in self.rank for x in (a, b)):
                raise VocabularyError(f"{path}: merge {rank} does not make a new token of earlier ones")
            self.parts[made], self.rank[made], self.pairs[a, b] = (a, b), rank, rank
        self.never = len(self.pairs)
        self._apart: dict[tuple[int, int], bool] = {}
        self.suffixes: dict = {}
        for t in sorted(ids.values(), key=lambda t: self.rank.get(t, -1)):
            if self._whole(t):
                node = self.suffixes
                for b in reversed(self.bytes[t]):
                    node = node.setdefault(b, {})
                node[_FINAL] = t
        self.size = {t: len(b) for t, b in self.bytes.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names))) if names else None

    def _edge(self, token: int, side: int, end: int) -> list[tuple[int, int]]:
        """Tokens at one edge of a token while it is made, the last first, with the rank that ends each."""
        out = [(token, end)]
        while token in self.parts:
            end, token = self.rank[token], self.parts[token][side]
            out.append((token, end))
        return out

    def _merged_across(self, left: int, right: int, end: int) -> bool:
        """Whether a merge takes bytes of both tokens before they end; of equal ranks the one more to the left is first."""
        heads = self._edge(right, 0, end)
        for a, end_a in self._edge(left, 1, end):
            for b, end_b in heads:
                rank = self.pairs.get((a, b))
                if rank is not None and rank < end_a and rank <= end_b:
                    return True
        return False

    def _whole(self, token: int) -> bool:
        """Whether the token's bytes are encoded as the token; some are never reached."""
        if token not in self.parts:
            return len(self.bytes[token]) == 1
        return not self._merged_across(*self.parts[token], self.rank[token]) and all(map(self._is_known, self.parts[token]))

    def _is_known(self, token: int) -> bool:
        node = self.suffixes
        for b in reversed(self.bytes[token]):
            node = node.get(b)
            if node is None:
                return False
        return node.get(_FINAL) == token

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay two when their bytes are encoded together."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) >= PAIRS:
                self._apart.clear()
            known = self._apart[left, right] = not self._merged_across(left, right, self.never)
        return known


def _trie_of(words: Iterable[str]) -> dict:
    """Words by their bytes. What no other word shares of a word is one leaf, its bytes and the word."""
    trie: dict = {}
    for w in words:
        data = w.encode()
        node = trie
        for at, b in enumerate(data):
            below = node.get(b)
            if below is None:
                node[b] = (data, w)
                break
            if type(below) is tuple:  # the leaf of a word that shares this byte moves down
                other, leaf = below[0], below
                below = node[b] = {}
                if len(other) > at + 1:
                    below[other[at + 1]] = leaf
                else:
                    below[_WORD] = leaf[1]
            node = below
        else:
            node[_WORD] = w
    return trie


def encode_words(vocabulary: Vocabulary, words: Iterable[str]) -> dict[str, bytes]:
    """Ids of distinct words, little-endian 32-bit.

    The words are put into a trie, which is walked depth first. The state of a node is the last token
    of its prefix's encoding, and follows from the states on the way to it; a prefix that
    many words share is therefore encoded once. The ids of a word are read back from its end.
    """
    suffixes, apart, size = vocabulary.suffixes, vocabulary.apart, vocabulary.size
    known = vocabulary._apart.get
    out: dict[str, bytes] = {}
    path, last = bytearray(), [-1]

    def read_back() -> bytes:
        ids, end = [], len(path)
        while end:
            token = last[end]
            ids.append(token)
            end -= size[token]
        ids.reverse()
        return array("I", ids).tobytes()

    waiting = [(node, 0, b) for b, node in _trie_of(words).items()]
    while waiting:
        node, depth, b = waiting.pop()
        leaf = type(node) is tuple
        del path[depth:], last[depth + 1 :]
        for b in node[0][depth:] if leaf else (b,):
            path.append(b)
            at, here = depth, suffixes
            while True:
                here = here[path[at]]
                token = here.get(_FINAL)
                if token is not None:
                    if not at:
                        break
                    stay = known((last[at], token))
                    if stay or (stay is None and apart(last[at], token)):
                        break
                at -= 1
            last.append(token)
            depth += 1
        if leaf:
            out[node[1]] = read_back()
            continue
        for b, below in node.items():
            if b != _WORD:
                waiting.append((below, depth, b))
            else:
                out[below] = read_back()
    return out


class Encoder:
    """Ids of whole texts and texts of ids; a worker process remembers words between tasks."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        # Words of late and words of before; the latter are dropped when there are too many of the former.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _unknown(self, words: set[str]) -> Iterator[str]:
        known, before = self.known, self.before
        for w in words:
            if w not in known:
                if (ids := before.get(w)) is None:
                    yield w
                else:
                    known[w] = ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts. Words of several texts are learned together, in tries of bounded size."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        new: set[str] = set()
        size = 0

        def flush() -> None:
            nonlocal size
            if len(self.known) > REMEMBERED:
                self.known, self.before = {}, self.known
            known, before = self.known, self.before
            known |= encode_words(self.vocabulary, new)
            for i, words in held:
                try:
                    ids = [known[w] for w in words]
                except KeyError:
                    ids = [known.get(w) or before[w] for w in words]
                out[i].append(b"".join(ids))
            held.clear()
            new.clear()
            size = 0

        for i, text in enumerate(texts):
            for special, piece in self._pieces(text or ""):
                if special is not None:
                    flush()
                    out[i].append(np.array([special], "<u4").tobytes())
                    continue
                for words in words_of(piece):
                    held.append((i, words))
                    fresh = [w for w in self._unknown(set(words)) if w not in new]
                    new.update(fresh)
                    size += sum(map(len, fresh)) + len(words)
                    if size > TRIE:
                        flush()
        flush()
        return [b"".join(p) for p in out]

    def _pieces(self, text: str) -> Iterator[tuple[int | None, str]]:
        """The id of each added token in a text, and the texts around them."""
        at = 0
        for m in self.vocabulary.specials.finditer(text) if self.vocabulary.specials else ():
            if m.start() > at:
                yield None, text[at : m.start()]
            yield self.vocabulary.added[m.group()], ""
            at = m.end()
        if at < len(text):
            yield None, text[at:]

    def decode(self, ids: bytes) -> str:
        """The text of ids; unknown ids are passed over, bytes that are no text become U+FFFD."""
        known = self.vocabulary.bytes
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            whole = b"".join([known[i] for i in numbers])
        except KeyError:
            whole = b"".join([known.get(i, b"") for i in numbers])
        return whole.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process: what a task has learned serves the next."""
    return Encoder(path)


def _slices(sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of ``HANDED`` bytes at most, or of one row."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > HANDED:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def _apply(path: str, schema: pa.Schema, decoded: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for b in batches:
        lengths = pc.binary_length(b.column("text")).fill_null(0).to_pylist()
        for rows in _slices(lengths):
            n = rows.stop - rows.start
            ids = own.encode(b.column("text").slice(rows.start, n).to_pylist())
            columns = [b.column("row").slice(rows.start, n), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array(map(own.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _made(docs: DataFrame, keep: list[str] | None, result: list[T.StructField]) -> tuple[list[str], T.StructType]:
    names = {f.name for f in result}
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in names]
    row = T.StructField("row", T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)] or [T.StructField("c", T.BooleanType())]))
    return kept, T.StructType([row, *result])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _row(kept: list[str]):
    return (F.struct(*[F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)]) if kept else F.struct(F.lit(None).cast("boolean").alias("c"))).alias("row")


def encode(
    docs: DataFrame, tokenizer: str, text_col: str = "text", keep: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """Token ids of every whole text: the columns of ``keep`` (all without it), ``n_tokens``, ``ids`` and, if asked for, ``decoded``.

    ``ids`` are little-endian 32-bit numbers, as the file ``tokenizer`` of byte-level BPE gives them without special
    tokens around them; its added tokens are found in the texts. ``decoded`` is the text of these ids,
    made in the same pass. Null texts count as empty and have no ids. Rows that repeat are
    encoded each; an empty table gives an empty one; input columns named as a result give way.

    Rows stay where they are: nothing is shuffled. A task holds the texts of a batch, handles these
    ``HANDED`` bytes at a time, and remembers a bounded number of words.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []
    kept, made = _made(docs, keep, fields)
    rows = docs.select(_row(kept), F.col(_quoted(text_col)).alias("text"))
    found = rows.mapInArrow(partial(_apply, tokenizer, to_arrow_schema(made), decoded), made)
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], *[f.name for f in fields])


def _texts(path: str, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for b in batches:
        lengths = pc.binary_length(b.column("ids")).fill_null(0).to_pylist()
        for rows in _slices(lengths):
            n = rows.stop - rows.start
            texts = [own.decode(x or b"") for x in b.column("ids").slice(rows.start, n).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row").slice(rows.start, n), pa.array(texts, pa.string())], schema=schema)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Texts of little-endian 32-bit ids: the columns of ``keep`` (all without it), then the text. Null ids are an empty text."""
    kept, made = _made(encoded, keep, [T.StructField(text_col, T.StringType())])
    rows = encoded.select(_row(kept), F.col(_quoted(ids_col)).alias("ids"))
    found = rows.mapInArrow(partial(_texts, tokenizer, to_arrow_schema(made)), made)
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.col(_quoted(text_col)))
