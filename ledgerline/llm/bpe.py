"""Byte-level BPE encoding and decoding by a shared-prefix trie.

A byte string's encoding extends the encodings of its prefixes: the last token
of a prefix is the one token that ends it and fits behind the last token of the
prefix before it.  So the distinct words of a slice of texts go into a trie,
and one depth-first walk hands the last tokens down: every node, that is every
prefix that words share, is worked out once.  The trie is kept as its sorted words, each with the depth at which it
leaves the one before, which is its depth-first order; a word's ids are read
backwards along its path.

Two neighbours fit if merging their bytes together gives exactly these two
tokens.  That follows from the ranks of the merges along the right edge of the
first and the left edge of the second token (``BpeModel.fits``).

The vocabulary, the merges and the added tokens come from a tokenizer file that
the caller names and the driver reads; its tables are broadcast (about 50,000
entries, ``max_vocab`` at most).  Words are split by the usual pattern, with the
letter, number and space classes that the tokenizer library itself has
(``library_pattern``).  Texts are encoded within their partition: no shuffle,
and a lost executor costs its running tasks only.  Memory is bounded by slices
of ``_SLICE_CHARS`` bytes (or one text) and caches of fixed size.

Defined cases: a null text is empty and has no ids; added tokens in a text get
their own id; a very long text is a slice of its own and a very long word one
path; bytes that are no UTF-8 decode to U+FFFD; repeated rows and null ids stay
rows; extra columns, also ``ids``, stay out of the way as only the named ones
are read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published word pattern of this family of tokenizers, a fixed value; {L}, {N}, {S} stand for the classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
_SLICE_CHARS = 4_000_000
_CACHE_CHUNKS = 700_000
_LONG_CHUNK = 1_000
_CACHE_PAIRS = 1_000_000
_LAST = 1 << 62


def _byte_chars() -> dict[str, int]:
    """Printable stand-in character of every byte, as byte-level vocabularies spell them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BpeModel:
    """Tables of a byte-level BPE tokenizer file."""

    def __init__(self, spec: dict, pattern: str, first_moved: str):
        model, chars = spec["model"], _byte_chars()
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix",
                                                                "end_of_word_suffix", "ignore_merges")):
            raise ValueError("not a plain byte-level BPE tokenizer")
        self.pattern, self.first_moved = pattern, first_moved
        self.plain_pattern = PATTERN.format(L="A-Za-z", N="0-9", S=r"\t-\r ")  # the same for ASCII
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(chars[c] for c in t) for t, i in model["vocab"].items() if t not in self.added}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        vocab = {b: i for i, b in self.bytes_of.items() if i not in self.added.values()}
        self.base = [vocab[bytes([b])] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, tuple[int, int, int]] = {}  # token -> its merge: rank, left, right
        for r, pair in enumerate(model["merges"]):
            left, right = (vocab[bytes(chars[c] for c in p)] for p in (pair.split(" ") if isinstance(pair, str)
                                                                       else pair))
            whole = vocab[self.bytes_of[left] + self.bytes_of[right]]
            self.rank[left, right] = r
            self.made_by.setdefault(whole, (r, left, right))
        # tokens that the merges of their own bytes lead to; no other can stand in an encoding
        self.vocab = {b: i for b, i in vocab.items() if self.merge(b) == [i]}
        self.step: dict[int, int] = {}  # tree of the tokens: node << 8 | byte -> node
        self.token_at = [-1]
        for data, i in self.vocab.items():
            node = 0
            for b in data:
                node = self.step.setdefault(node << 8 | b, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i
        # nodes that lead on come first, the others are not followed
        inner = {edge >> 8 for edge in self.step} | {0}
        order = sorted(range(len(self.token_at)), key=lambda n: (n not in inner, n))
        number = {old: new for new, old in enumerate(order)}
        self.step = {number[edge >> 8] << 8 | edge & 255: number[node] for edge, node in self.step.items()}
        self.token_at, self.n_inner = [self.token_at[n] for n in order], len(inner)
        self.first_steps = [n if n < self.n_inner else None for n in map(self.step.__getitem__, range(256))]
        self.size_of = {i: len(b) for b, i in self.vocab.items()}
        self.little_endian = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.known_fits: dict[int, bool] = {}
        self._encoder: Encoder | None = None

    def merge(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost of equals."""
        ids = [self.base[b] for b in data]
        while len(ids) > 1:
            r, i = min((self.rank.get(p, _LAST), i) for i, p in enumerate(zip(ids, ids[1:])))
            if r == _LAST:
                break
            whole = self.bytes_of[ids[i]] + self.bytes_of[ids[i + 1]]
            ids[i:i + 2] = [self._id(whole)]
        return ids

    def _id(self, data: bytes) -> int:
        if not hasattr(self, "_ids"):
            self._ids = {b: i for i, b in self.bytes_of.items() if i not in self.added.values()}
        return self._ids[data]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at the edge while ``token`` forms, each with the rank at which it is merged away."""
        out, until = [(token, _LAST)], _LAST
        while token in self.made_by:
            until = self.made_by[token][0]
            token = self.made_by[token][side]
            out.append((token, until))
        return out

    def fits(self, first: int, second: int) -> bool:
        """No merge across the border comes before those that form the two.
        Of equal ranks the left merge comes first."""
        right = self._edge(second, 1)
        found = not any((r := self.rank.get((x, y), _LAST)) < gone_x and r <= gone_y and r < _LAST
                        for x, gone_x in self._edge(first, 2) for y, gone_y in right)
        if len(self.known_fits) >= _CACHE_PAIRS:
            self.known_fits.clear()
        self.known_fits[first << 32 | second] = found
        return found

    def encoder(self) -> Encoder:
        """One encoder per worker process, so that its caches serve all its tasks."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def __getstate__(self):
        return self.__dict__ | {"known_fits": {}, "_encoder": None}


def library_pattern(pre_tokenizer) -> tuple[str, str]:
    """``PATTERN`` with the character classes of the installed tokenizer
    library, whose Unicode tables may be older or newer than those of
    ``regex``: whole runs of one class are asked for, single characters only
    where a run does not come back in one piece, and the characters that the
    two see differently are moved from class to class.  Also the first of these."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    probe = {"L": "a", "N": "1", "O": "!"}
    moved: dict[str, list[int]] = {k: [] for k in ("all", "L", "N", "S", "O")}
    for m in regex.finditer(r"(?P<L>\p{L}+)|(?P<N>\p{N}+)|(?P<S>\s)|(?P<O>[^\s\p{L}\p{N}]+)", everything):
        run, k = m[0], m.lastgroup
        if k != "S" and len(pre_tokenizer.pre_tokenize_str(probe[k] + run)) == 1:
            continue
        for c in run:
            own = next((p for p in probe if len(pre_tokenizer.pre_tokenize_str(probe[p] + c)) == 1), "S")
            if own != k:
                moved["all"].append(ord(c))
                moved[own].append(ord(c))

    def spans(points: list[int]) -> str:
        there = set(points)
        starts, ends = [p for p in points if p - 1 not in there], [p for p in points if p + 1 not in there]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))

    def without(kind: str) -> str:
        return f"[{kind}--[{spans(moved['all'])}]]" if moved["all"] else kind

    if moved["all"] and min(moved["all"]) < 128:
        raise ValueError("unusual classes of ASCII characters")
    kinds = {k: without(c) + spans(moved[k]) for k, c in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    return "(?V1)" + PATTERN.format(**kinds), chr(min(moved["all"], default=0x10FFFF))


@lru_cache(maxsize=2)
def load_model(path: str, max_vocab: int = 300_000) -> BpeModel:
    """The tokenizer file at ``path``, read on the driver."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        raise ValueError("not a byte-level tokenizer without normaliser and prefix space")
    if any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("added tokens must match literally")
    if len(spec["model"]["vocab"]) > max_vocab:
        raise ValueError(f"vocabulary of over {max_vocab} tokens")
    return BpeModel(spec, *library_pattern(Tokenizer.from_file(path).pre_tokenizer))


def insert(words: Iterable[bytes]) -> list[tuple[int, bytes]]:
    """Trie of distinct words in depth-first order: each word is a branch,
    with the depth at which it leaves the branch before it."""
    trie, before = [], b""
    for word in sorted(words):
        depth, most = 0, min(len(word), len(before))
        while depth < most and word[depth] == before[depth]:
            depth += 1
        trie.append((depth, word))
        before = word
    return trie


def walk(trie: list[tuple[int, bytes]], model: BpeModel) -> Iterator[tuple[bytes, list[int]]]:
    """(word, ids) of every word, depth first.  ``last[d]`` is the last token
    of the first d bytes of the current path, ``open_at[d]`` the starts from
    which the path is the beginning of a longer token, with the token tree's node;
    below a fork only the new nodes are worked out."""
    step, token_at, base, first = model.step.get, model.token_at, model.base, model.first_steps
    known, fits, size, inner = model.known_fits.get, model.fits, model.size_of, model.n_inner
    last, open_at = [-1], [[]]
    for fork, word in trie:
        del last[fork + 1:], open_at[fork + 1:]
        going = open_at[fork]
        for depth in range(fork, len(word)):
            byte, found, before, going = word[depth], -1, going, []
            for start, node in before:
                node = step(node << 8 | byte)
                if node is not None:
                    if node < inner:
                        going.append((start, node))
                    if found < 0:
                        token = token_at[node]
                        if token >= 0:
                            if not start:
                                found = token
                            else:
                                ok = known(last[start] << 32 | token)
                                if ok or ok is None and fits(last[start], token):
                                    found = token
            node = first[byte]
            if node is not None:        # longer tokens begin with this byte
                going.append((depth, node))
            last.append(found if found >= 0 else base[byte])     # one token always fits, at least the byte
            open_at.append(going)
        token, at = last[-1], len(word) - size[last[-1]]
        ids = [token]
        while at:
            token = last[at]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        yield word, ids


class Encoder:
    """Encodes slices of texts; keeps the ids of chunks seen before.

    A word never runs across the start of white space, so a text is cut at
    single spaces behind other characters and each distinct chunk (with its
    space) is split by the pattern and encoded once.
    """

    def __init__(self, model: BpeModel):
        self.model, self.known = model, {}
        self.added_ids = {a: i.to_bytes(4, "little") for a, i in model.added.items()}
        self.words = dict(self.added_ids)
        ascii_only = re.compile(model.plain_pattern).findall
        exact = regex.compile(model.pattern).findall
        usual = regex.compile(PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=r"\s")).findall
        self.split = lambda c: ascii_only(c) if c.isascii() else (usual if max(c) < model.first_moved else exact)(c)
        # spaces behind white space do not start a chunk; such texts are one chunk between added tokens
        self.uneven = re.compile(r"\s ").search
        self.added = (re.compile("(" + "|".join(map(re.escape, sorted(model.added, key=len, reverse=True))) + ")").split
                      if model.added else lambda text: [text])

    def _chunks(self, text: str) -> list[str]:
        out: list[str] = []
        for i, part in enumerate(self.added(text)):
            if i % 2 or not part or self.uneven(part):
                out.append(part)
            else:
                first, *rest = part.split(" ")
                out.append(first)
                out += [" " + c for c in rest]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        chunks = [self._chunks(t) for t in texts]
        new = set().union(*chunks).difference(self.known)
        if len(self.known) + len(new) > _CACHE_CHUNKS:  # what this slice holds is worth keeping
            self.known = {c: self.known[c] for c in set().union(*chunks) if c in self.known}
            self.words = dict(self.added_ids)
        split = {c: [c] if c in self.model.added else self.split(c) for c in new}
        fresh, le = set().union(*split.values()).difference(self.words), self.model.little_endian
        ids, long = self.words, max(map(len, new), default=0) > _LONG_CHUNK
        for word, tokens in walk(insert(w.encode() for w in fresh), self.model):
            ids[word.decode()] = b"".join([le[t] for t in tokens])
        self.known.update((c, ids[w[0]] if len(w) == 1 else b"".join([ids[x] for x in w])) for c, w in split.items())
        out = [b"".join(map(self.known.__getitem__, c)) for c in chunks]
        if long:  # not worth their memory
            self.known = {c: i for c, i in self.known.items() if len(c) <= _LONG_CHUNK}
            self.words = {c: i for c, i in self.words.items() if len(c) <= _LONG_CHUNK} | self.added_ids
        return out


def decode(ids: bytes, table: dict[int, bytes]) -> str:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def slices(texts: list[bytes], chars: int = _SLICE_CHARS) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``chars`` bytes."""
    held, n = [], 0
    for t in texts:
        if held and n + len(t) > chars:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t)
    if held:
        yield held


def _values(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def encode_texts(docs: DataFrame, model: BpeModel, text_col: str = "text", id_col: str = "doc_id",
                 decoded: bool = False) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every whole
    text; with ``decoded`` also the text that these ids stand for, as
    :func:`decode_ids` gives it, in the same pass."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = shared.value.encoder(), shared.value.bytes_of
        for b in batches:
            at = 0
            for part in slices(_values(b.column(1))):
                ids = encoder.encode([t.decode("utf-8", "replace") for t in part])
                columns = [b.column(0).slice(at, len(part)), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([decode(i, table) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][:len(columns)])
                at += len(part)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids binary{', text string' if decoded else ''}")


def decode_ids(coded: DataFrame, model: BpeModel, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """doc_id, ids and text of every id sequence; added tokens are kept."""
    src = coded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    shared = coded.sparkSession.sparkContext.broadcast(model.bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            at = 0
            for part in slices(_values(b.column(1))):
                text = pa.array([decode(ids, table) for ids in part], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(part)) for c in b.columns), text],
                                                 ["doc_id", "ids", "text"])
                at += len(part)

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids binary, text string")
