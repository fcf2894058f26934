"""Byte-level BPE encoding and decoding (9).

Bytes are mapped to Latin-1 text, so one automaton over the vocabulary finds,
for each start, the longest token that begins there. Encoding walks left to
right, takes the longest token compatible with the one before it, and
backtracks to the next shorter token where none fits: two adjacent tokens
are compatible when the merges of their joined bytes give back exactly these
two, a fact that is memoised per pair. A position proven to be a dead end is
never entered again, so the work is linear in the bytes, and the result is
exactly that of applying merges in rank order.

Pieces come from the public split pattern. A text is cut at single spaces
first (no match of the pattern spans such a cut) and each distinct chunk is
encoded once per worker; the memo is bounded and only a cache.

Null text counts as empty: no ids, and the hash of no bytes. Repeated rows
stay; texts are encoded whole, however long; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from farecast.llm.common import map_slices

MEMO_BYTES = 128 << 20  # of each cache of a worker
ENTRY_BYTES = 220  # of an entry beside its characters and ids
LONGEST = 64  # characters of a kept key: texts without spaces make keys of whole paragraphs
PAIRS = 1 << 20

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


class Memo:
    """Two-generation cache bounded in bytes: when the young half is full it becomes the old half, whose
    entries move back when they are asked for again, so frequent keys stay. Long keys are not kept."""

    def __init__(self, size: int):
        self.young, self.old, self.half, self.size = {}, {}, size // 2, 0
        self.get = self.young.get

    def find(self, key):
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(key) > LONGEST:
            return
        if self.size >= self.half:
            self.young, self.old, self.size = {}, self.young, 0
            self.get = self.young.get
        self.size += len(key) + len(value) + ENTRY_BYTES
        self.young[key] = value


class ByteBPE:
    """Encoder and decoder for one rank table (token bytes -> rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.tokens = {r: t for t, r in ranks.items()}
        self.sizes = np.zeros(max(self.tokens) + 1, np.int64)
        for r, t in self.tokens.items():
            self.sizes[r] = len(t)
        self.lengths = self.sizes.tolist()
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.blob = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(len(self.sizes))), np.uint8)
        self.trie = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.trie.add_word(t.decode("latin-1"), r)
        self.trie.make_automaton()
        self.prefix: dict[int, int] = {}  # token -> next shorter token that is its prefix, -1 if none
        self.fits: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.memo = Memo(MEMO_BYTES)  # chunk after a space -> ids
        self.known = Memo(MEMO_BYTES)  # piece -> ids

    # -- merges ---------------------------------------------------------
    def shorter(self, token: int) -> int:
        found = self.prefix.get(token)
        if found is None:
            t = self.tokens[token]
            found = next((r for n in range(len(t) - 1, 0, -1) if (r := self.ranks.get(t[:n])) is not None), -1)
            self.prefix[token] = found
        return found

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one: split off at the last merge of its bytes; None for a byte."""
        if token in self.split:
            return self.split[token]
        t, ranks = self.tokens[token], self.ranks
        seq = [t[i : i + 1] for i in range(len(t))]
        while len(seq) > 2:
            best, at = None, -1
            for i in range(len(seq) - 1):
                r = ranks.get(seq[i] + seq[i + 1])
                if r is not None and r < token and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            seq[at : at + 2] = [seq[at] + seq[at + 1]]
        out = (ranks[seq[0]], ranks[seq[1]]) if len(seq) == 2 else None
        self.split[token] = out
        return out

    def compatible(self, left: int, right: int) -> bool:
        """True when the merges of left + right leave exactly these two tokens.

        Undo the later-ranked merge of the two on the side of the seam again
        and again: if, at any point, the tokens that meet at the seam have a
        merge of a lower rank than the one undone last, that merge would have
        come first and the pair cannot arise.
        """
        tokens, ranks = self.tokens, self.ranks
        a, b, limit, ok = left, right, 1 << 62, True
        while ok:
            seam = ranks.get(tokens[a] + tokens[b])
            ok = seam is None or seam >= limit
            # undo the later merge; a byte has none, then the other side's
            on_left = self.parts(a) is not None and (a > b or self.parts(b) is None)
            if on_left:
                limit, a = a, self.parts(a)[1]
            elif self.parts(b) is not None:
                limit, b = b + 1, self.parts(b)[0]  # the same rank further left would have come first
            else:
                break
        if len(self.fits) > PAIRS:
            self.fits.clear()
        self.fits[left << 32 | right] = ok
        return ok

    # -- encoding -------------------------------------------------------
    def encode_piece(self, piece: str) -> bytes:
        """A piece that is a token stays whole, as in the public library."""
        got = self.known.find(piece)
        if got is None:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            got = array("I", self.backtrack(raw) if whole is None else [whole]).tobytes()
            self.known.put(piece, got)
        return got

    def backtrack(self, piece: bytes) -> list[int]:
        n, lengths, fits = len(piece), self.lengths, self.fits
        next_token = [0] * n  # for each start the longest token there: matches come by growing end
        for end, token in self.trie.iter(piece.decode("latin-1")):
            next_token[end + 1 - lengths[token]] = token
        dead = bytearray(n + 1)
        out: list[int] = []
        last, at, token = -1, 0, next_token[0]
        while True:
            end = at + lengths[token]
            if not dead[end]:
                ok = last < 0 or fits.get(last << 32 | token)
                if ok is None:
                    ok = self.compatible(last, token)
                if ok:
                    out.append(token)
                    if end == n:
                        return out
                    last, at, token = token, end, next_token[end]
                    continue
            token_ = self.shorter(token)
            if token_ >= 0:
                token = token_
                continue
            dead[at] = 1  # nothing fits here: take the token before back and try its shorter prefixes
            token = out.pop()
            at -= lengths[token]
            last = out[-1] if out else -1

    def encode_chunk(self, chunk: str) -> bytes:
        word = chunk[1:]
        if word.isascii() and word.isalpha() and chunk[0] == " ":  # one piece; spares the pattern
            return self.encode_piece(chunk)
        return b"".join(map(self.encode_piece, self.pieces(chunk)))

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        memo = self.memo
        head, *rest = text.split(" ")
        out = list(map(memo.get, rest))
        if None in out:
            for i in [i for i, got in enumerate(out) if got is None]:
                c = rest[i]
                if (got := memo.find(c)) is None:
                    loose = not c or c[0].isspace() or c[-1].isspace()
                    memo.put(c, got := b"?" if loose else self.encode_chunk(" " + c))
                out[i] = got
        if b"?" in out or not head or head[-1].isspace():  # white space next to a cut: the pattern looks across it
            return self.encode_chunk(text)
        return self.encode_chunk(head) + b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Concatenated token bytes, gathered without a Python loop."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.blob[shift + np.arange(ends[-1])].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> ByteBPE:
    """One encoder per worker process, vocabulary and pattern."""
    return ByteBPE(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row; null text is empty, repeated rows stay."""

    def make():
        bpe = encoder(ranks_path, pattern)

        def fn(c):
            n, ids_sha, text_sha = [], [], []
            for text in c["text"]:
                raw = bpe.encode_bytes(text or "")
                n.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode_bytes(np.frombuffer(raw, "<u4"))).hexdigest())
            return {"doc_id": c["doc_id"], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

        return fn

    return map_slices(docs.select("doc_id", "text"), make, SCHEMA)


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) per row."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def make():
        bpe = encoder(ranks_path, pattern)
        return lambda c: {"doc_id": c["doc_id"], "ids": [bpe.encode(t or "") for t in c["text"]]}

    return map_slices(docs.select("doc_id", "text"), make, schema)


def decode_ids(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) back from (doc_id, ids); ids that cut a character give replacement characters."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def make():
        bpe = encoder(ranks_path, pattern)
        return lambda c: {
            "doc_id": c["doc_id"],
            "text": [bpe.decode_bytes(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in c["ids"]],
        }

    return map_slices(rows.select("doc_id", "ids"), make, schema)
