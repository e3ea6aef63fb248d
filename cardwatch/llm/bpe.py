"""BPE encoding and decoding through a tokenization automaton.

The merges of a byte-level BPE vocabulary are compiled, in order, into a
deterministic automaton whose arcs carry tokens and whose accepted label
sequences are exactly the token sequences that BPE produces.  It starts as one
state with a loop for every byte.  The gadget of merge ``u v -> w``

* copies the state behind ``v`` as the state behind ``w``,
* takes the arc ``v`` out of the state behind ``u``,
* adds an arc ``w`` to every state that has an arc ``u``.

All arcs with one label lead to one state, so a state is named by the token
before it.  A state is stored as its differences: the state it was copied from
and when, and the arcs taken out of it (``removed``); an arc as the arc it was
added along and when.  :meth:`Automaton.arc` follows these links, so the tables
grow with the number of merges and not with its square.

Encoding reads a pre-split word byte by byte through a transition table, without
going back.  One path of the automaton spells any string, so each prefix of a
word has one last token.  A byte state is the longest end of the prefix that
begins a label (a node of the labels' trie) with the last tokens of the prefixes
that end inside it; a byte takes the node along its arc, or along the arc of the
next shorter end (the default arcs of a trie with failure links), and the
new prefix's last token is the one label ending here that the automaton has an arc
for behind the token before it.  A transition is worked out when it is first met
and then is an entry of the table (state, byte) -> state, which holds the
token too; the table is bounded by ``STATES``.  The tokens are read off from the
end of the word.  Decoding emits the labels of the arcs.

A chunk of texts is pre-split by vectorised rules equal to the byte-level
pattern (``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``);
each distinct word is encoded once and remembered by its hash in a bounded
table.  Every chunk is decoded again and compared with its text, so that a hash
collision cannot pass: such a chunk is encoded word by word.

Null texts are empty: no token, and the digests of nothing.  Copies of a row
give the same row again; an empty table gives an empty table; further columns
are ignored.  The vocabulary file is a parameter, read by the driver, compiled by
a task and sent to the executors (its size is that of the vocabulary).
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns
from cardwatch.session import ship_package

START = -1
LETTER, NUMBER, OTHER, SPACE, BREAK = range(5)
#: The code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Distinct words remembered by a worker.
REMEMBERED = 2_000_000
#: Byte states of the transition table of a worker.
STATES = 200_000
#: Code points classified together.
BLOCK = 1 << 13


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def code_point_classes() -> np.ndarray:
    """Class of every code point, as the patterns of the public tokenizers library see it (its Unicode version)."""
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    patterns = [(Split(Regex(pattern), "removed", invert=True), kind) for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER))]
    # a block at a time: the library keeps an alignment of every byte
    for block in np.split(np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))), range(BLOCK, 0x10F800, BLOCK)):
        text = "".join(map(chr, block.tolist()))
        for pattern, kind in patterns:
            for run, _ in pattern.pre_tokenize_str(text):
                classes[[ord(x) for x in run]] = kind
    classes[WHITE_SPACE] = SPACE
    return classes


class Automaton:
    """The compiled merges of one vocabulary."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.size = n = max([*vocab.values(), *self.special.values()]) + 1
        self.label: list[bytes] = [b""] * n
        for token, i in vocab.items():
            if token.encode() not in self.special:
                self.label[i] = bytes(letters[x] for x in token)
        for token, i in self.special.items():
            self.label[i] = token
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.left, self.right = [-1] * n, [-1] * n
        self.made = [-1] * n  # the gadget that made the token; -1 for bytes
        self.removed: dict[int, int] = {}
        exists = {vocab[x] for x in letters}
        for k, (u, v) in enumerate((vocab[a], vocab[b]) for a, b in merges):
            w = vocab[self._spell(spec, u, v, vocab)]
            if u in exists and v in exists and w not in exists and self._arc(u, v, k):
                self.left[w], self.right[w], self.made[w] = u, v, k
                self.removed[u * n + v] = k
                exists.add(w)
        self._trie(exists)
        self._clear()
        self.classes = code_point_classes()
        lens = np.fromiter(map(len, self.label), np.int64, n)
        self.label_len, self.label_at = lens, np.cumsum(lens) - lens
        self.labels = np.frombuffer(b"".join(self.label), dtype=np.uint8)
        self.special_pattern = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or rb"(?!)")
        self._forget()

    def _spell(self, spec: dict, u: int, v: int, vocab: dict[str, int]) -> str:
        if not hasattr(self, "_token"):
            self._token = {i: t for t, i in vocab.items()}
        return self._token[u] + self._token[v]

    def _trie(self, tokens: set[int]) -> None:
        """A byte trie of the labels with failure links; of each node its depth and the labels that end there, longest first."""
        self.children: list[dict[int, int]] = [{}]
        self.depth, own = [0], [-1]
        for t in sorted(tokens):
            node = 0
            for b in self.label[t]:
                deeper = self.children[node].get(b)
                if deeper is None:
                    deeper = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.depth.append(self.depth[node] + 1)
                    own.append(-1)
                node = deeper
            own[node] = t
        self.length = [len(x) for x in self.label]
        self.fail, self.ends = [0] * len(own), [()] * len(own)
        level = [0]
        while level:  # a level of the trie at a time: every shorter end is done
            below = []
            for node in level:
                for b, deeper in self.children[node].items():
                    self.fail[deeper] = self._node_after(self.fail[node], b) if node else 0
                    shorter = self.ends[self.fail[deeper]]
                    self.ends[deeper] = shorter if own[deeper] < 0 else (own[deeper], *shorter)
                    below.append(deeper)
            level = below
        del self._token

    def _node_after(self, node: int, b: int) -> int:
        """The longest end that begins a label, after one more byte."""
        while (deeper := self.children[node].get(b)) is None:
            if not node:
                return 0
            node = self.fail[node]
        return deeper

    def _clear(self) -> None:
        """An empty transition table: state 0 is the start of a word."""
        self._states: dict[tuple, int] = {(0, (START,)): 0}
        self._of, self._last = [(0, (START,))], [START]
        self._next: dict[int, int] = {}
        self._arcs = {}

    def _forget(self) -> None:
        """The remembered words: sorted hashes, and where each one's tokens stand in the arena."""
        self.known = np.zeros(0, dtype=np.uint64)
        self.known_at, self.known_len = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.arena = array("I")

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "known_at", "known_len", "arena", "_arcs", "_states", "_of", "_last", "_next")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._clear()
        self._forget()

    def _arc(self, x: int, y: int, t: int) -> bool:
        """Whether the state behind token x has an arc y once the first t gadgets are in place."""
        removed, made, n = self.removed, self.made, self.size
        while True:
            k = removed.get(x * n + y)
            if k is not None and k < t:
                return False
            if made[y] >= made[x]:
                if made[y] < 0:
                    return True
                t, y = made[y] + 1, self.left[y]
            else:
                t, x = made[x], self.right[x]

    def arc(self, x: int, y: int) -> bool:
        """Whether the state behind token x has an arc y."""
        key = x * self.size + y
        known = self._arcs.get(key)
        if known is None:
            known = self._arcs[key] = self._arc(x, y, len(self.made))
        return known

    def _transition(self, state: int, b: int) -> int:
        """Work out the table's entry for a state and a byte."""
        node, last = self._of[state]
        node = self._node_after(node, b)
        for t in self.ends[node]:
            before = last[-self.length[t]]
            if before == START or self.arc(before, t):
                break
        else:
            raise ValueError("the vocabulary can't spell this word")
        # the last tokens of the prefixes that end inside the node, and of the one it begins behind
        key = (node, (*last, t)[-self.depth[node] - 1 :])
        after = self._states.get(key)
        if after is None:
            after = self._states[key] = len(self._of)
            self._of.append(key)
            self._last.append(t)
        self._next[state << 8 | b] = after
        return after

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of one pre-split word: one look-up a byte, then the last token of the whole, of what is before it, and so on."""
        if len(self._of) > STATES:
            self._clear()
        table, last, length = self._next, self._last, self.length
        state, ends = 0, []
        for b in word:
            after = table.get(state << 8 | b)
            state = self._transition(state, b) if after is None else after
            ends.append(last[state])
        out, at = [], len(word)
        while at:
            out.append(ends[at - 1])
            at -= length[ends[at - 1]]
        out.reverse()
        return out

    def split(self, c: S.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of the pre-split words of a chunk."""
        text = np.frombuffer(c.buf.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lead = np.append(np.flatnonzero((c.buf & 0xC0) != 0x80), len(c.buf))
        kind = self.classes[text]
        kind[np.searchsorted(lead, c.end)] = BREAK
        # breaks are single: every one ends a text, even where empty texts follow each other
        at = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == BREAK))))
        end = np.append(at[1:], len(kind))
        k, nxt = kind[at], np.append(kind[at[1:]], BREAK)
        space = (k == SPACE) & (nxt != BREAK)
        blank_before = np.concatenate(([False], (space & (text[end - 1] == 0x20))[:-1]))
        begins = np.zeros(len(kind) + 1, dtype=bool)
        begins[at[(k != BREAK) & ~blank_before]] = True
        begins[end[space] - 1] = True
        quote = np.flatnonzero((k == OTHER) & (end - at == 1) & (text[at] == 0x27) & ~blank_before & (nxt == LETTER))
        if len(quote):
            p, size = at[quote], (end - at)[quote + 1]
            one, two = text[p + 1], np.where(size > 1, text[np.minimum(p + 2, len(text) - 1)], 0)
            letters = np.where(np.isin(one, [ord(x) for x in "stmd"]), 1, 0)
            for a, b in ("re", "ve", "ll"):
                letters[(one == ord(a)) & (two == ord(b))] = 2
            cut = letters > 0
            begins[p[cut] + 1] = False
            begins[(p + 1 + letters)[cut & (size > letters)]] = True
        start = np.flatnonzero(begins[:-1])
        stops = np.flatnonzero(begins[:-1] | (kind == BREAK))
        stop = stops[np.searchsorted(stops, start, side="right")]
        return lead[start], lead[stop]

    def encode_chunk(self, c: S.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a chunk's texts without special tokens, and the first token of each text (one more at the end)."""
        start, end = self.split(c)
        h = S.hash_runs(c.buf, start, end)
        unique, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, unique)
        new = np.flatnonzero(np.append(self.known, 0)[at] != unique) if len(self.known) else np.arange(len(unique))
        raw = c.buf
        if len(new):
            words = [self.encode_word(raw[a:b].tobytes()) for a, b in zip(start[where[new]].tolist(), end[where[new]].tolist(), strict=True)]
            lens = np.fromiter(map(len, words), np.int64, len(words))
            self.known = np.insert(self.known, at[new], unique[new])
            self.known_at = np.insert(self.known_at, at[new], len(self.arena) + np.cumsum(lens) - lens)
            self.known_len = np.insert(self.known_len, at[new], lens)
            self.arena.extend(t for w in words for t in w)
            at = np.searchsorted(self.known, unique)
        arena = np.frombuffer(self.arena, dtype=np.uint32).copy()
        mine = at[inverse]
        ids, lens = _gather(arena, self.known_at[mine], self.known_len[mine])
        before = np.concatenate(([0], np.cumsum(lens)))
        first = before[np.searchsorted(start, np.append(c.start, len(c.buf)))]
        if not self._same(c, ids, first):
            words = [self.encode_word(raw[a:b].tobytes()) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            before = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
            ids = np.array([t for w in words for t in w], dtype=np.uint32)
            first = before[np.searchsorted(start, np.append(c.start, len(c.buf)))]
        return ids, first

    def _same(self, c: S.Chunk, ids: np.ndarray, first: np.ndarray) -> bool:
        inside = np.ones(len(c.buf), dtype=bool)
        inside[c.end] = False
        return np.array_equal(self.label_bytes(ids), c.buf[inside])

    def label_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The labels of the arcs, one after the other."""
        return _gather(self.labels, self.label_at[ids], self.label_len[ids])[0]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of whole texts; special tokens in a text become their id."""
        pieces, owner, between = [], [], []
        for d, t in enumerate(texts):
            at = 0
            for m in self.special_pattern.finditer(t):
                pieces.append(t[at : m.start()])
                owner.append(d)
                between.append(self.special[m.group()])
                at = m.end()
            pieces.append(t[at:])
            owner.append(d)
            between.append(-1)
        if not pieces:
            return []
        ids, first = self.encode_chunk(S.chunk_of(np.array(owner), pieces))
        if len(pieces) == len(texts):
            return [ids[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for p, d in enumerate(owner):
            out[d].append(ids[first[p] : first[p + 1]])
            if between[p] >= 0:
                out[d].append(np.array([between[p]], dtype=np.uint32))
        return [np.concatenate(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        return self.label_bytes(ids).tobytes().decode("utf-8", "replace")


def _gather(source: np.ndarray, at: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """source[at : at + lens] for every row, one after the other."""
    total = int(lens.sum())
    shift = at - (np.cumsum(lens) - lens)
    return source[np.arange(total, dtype=np.int64) + np.repeat(shift, lens)], lens


class Pickled:
    """An object in its pickled form: the driver passes the bytes on, what unpickles them gets the object."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self):
        return pickle.loads, (self.data,)


def automaton(spark: SparkSession, vocabulary: str | None = None) -> Broadcast:
    """The compiled automaton on every executor; its size is bound by the vocabulary file.

    A task compiles it: the driver holds the vocabulary's text and the pickled
    tables for the time of the call, never the automaton itself.
    """
    ship_package(spark)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        text = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            machine = pickle.dumps(Automaton(text.value), pickle.HIGHEST_PROTOCOL)
            yield pa.RecordBatch.from_arrays([pa.array([machine] * b.num_rows, pa.binary())], names=["automaton"])
        S.give_back()

    row = spark.range(0, 1, 1, 1).mapInArrow(run, "automaton binary").first()
    return spark.sparkContext.broadcast(Pickled(bytes(row["automaton"])))


def _compiled(path: str) -> Automaton:
    """The automaton in this process."""
    with open(path, encoding="utf-8") as f:
        return Automaton(f.read())


def encode_decode(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, token count, digests of the ids and of the decoded text, and with ``with_ids`` the ids; no shuffle."""
    machine = automaton(docs.sparkSession, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Automaton = machine.value
        for c in S.chunks(batches):
            ids = a.encode(c.texts)
            cols = [
                c.ids,
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(a.decode(x).encode()).hexdigest() for x in ids], pa.string()),
            ]
            if with_ids:
                cols.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=NAMES + ["ids"] * with_ids)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return text_columns(docs).mapInArrow(run, schema)


NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
