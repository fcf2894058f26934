"""Token ids of whole texts by the public ``tokenizers`` library, each distinct word once.

No token of the word vocabularies served here spans white space, so the ids
of a text are those of its white-space separated chunks one after another.
Distinct chunks new to a worker are handed to the library together, joined
by a marker token; what it returned for a chunk is kept in a cache bounded in
bytes (chunks of over ``LONGEST`` characters, as texts without spaces have them,
are not kept at all).
The library alone turns text into ids. A text that holds the literal of a
special token, in any case, goes to it whole: there the literal is that
token's id (the library's default), which chunks must not make or break.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from operator import itemgetter

import numpy as np

from farecast.llm.common import release_before_other_work

MEMO_BYTES = 224 << 20  # of cached chunks a worker, in two generations; the older one is dropped whole
ENTRY_BYTES = 220  # of a cached chunk beside its characters and ids
LONGEST = 64
MARK = "\x01"
CLOSE = "</w>"  # ends the tokens that end a word
_ODD = "\x1c\x1d\x1e\x1f"  # white space to str.split(), not to the library
_cut = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+").findall
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation without the apostrophe


def _chunks(text: str) -> list[str]:
    """What is left of a text between the white space that the library removes."""
    return _cut(text) if any(c in text for c in _ODD) else text.split()


def _lower(text: str) -> str:
    """ASCII letters lowered, as the library does to all letters later. Before a combining mark they are left
    to it: it composes letters and marks first, and some small letters compose where the large one does not."""
    if text.isascii():
        return text.lower()
    raw = text.encode("utf-8", "surrogatepass")
    if b"\xcc" in raw or b"\xcd" in raw:  # lead bytes of the combining marks
        return " ".join([w.lower() if w.isascii() else w for w in _chunks(text)])
    return raw.lower().decode("utf-8", "surrogatepass")


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # the library knows special tokens by their literals before it lowers letters, chunks are lowered first
        self.special = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.sign = re.match("[^a-z]*", os.path.commonprefix(self.special)).group()
        marks = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark = marks[0] if len(marks) == 1 else None
        vocabulary = self.library.get_vocab()
        self.marks, self.closes = (np.zeros(max(vocabulary.values(), default=0) + 1, bool) for _ in range(2))
        self.marks[marks] = True
        # a run of letters is one word to the library, and only its last token closes a word
        self.closes[[i for t, i in vocabulary.items() if t.endswith(CLOSE)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0  # bytes of the young ones

    def _whole(self, text: str) -> bool:
        if not self.special or self.sign not in text:
            return False
        lower = text.lower()
        return any(s in lower for s in self.special)

    def _direct(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ask(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, many handed over at once; letters alone are told apart by their last tokens, the rest by a mark."""
        if self.mark is None:
            return {w: self._direct(w) for w in words}
        letters = [w for w in words if w.isalpha()]
        odd = [w for w in words if MARK in w]
        rest = [w for w in words if not w.isalpha() and MARK not in w]
        out = {w: self._direct(w) for w in odd}
        for some, between, is_end, skip in ((letters, " ", self.closes, 0), (rest, f" {MARK} ", self.marks, 1)):
            parts = [some[at : at + 2_000] for at in range(0, len(some), 2_000)]
            # the fast form gives the same ids and spares the places of tokens in the text
            got = self.library.encode_batch_fast([between.join([*part, ""]) for part in parts], add_special_tokens=False)
            for part, encoded in zip(parts, got):
                ids = np.array(encoded.ids, "<u4")
                ends = np.flatnonzero(is_end[ids])
                if len(ends) != len(part):  # a word is several words to the library, or held the mark's token
                    out |= {w: self._direct(w) for w in part}
                    continue
                raw, ends = ids.tobytes(), (4 * (ends + 1)).tolist()
                out |= {w: raw[a : b - 4 * skip] for w, a, b in zip(part, [0, *ends], ends)}
        return out

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of new chunks; a letter run and the ASCII punctuation after it are separate words to the library."""
        young, old, parts = self.young, self.old, {}
        ask: set[str] = set()
        for c in missing:
            stem = c.rstrip(_TAIL)
            if stem and stem != c and stem[-1] < "ɐ" and stem[-1].lower().isalpha() and "'" not in stem:
                tail = c[len(stem) :]
                parts[c] = (stem, tail)
                ask.update(w for w in (stem, tail) if w not in young and w not in old)
            else:
                ask.add(c)
        got = self._ask(list(ask))
        for c, (stem, tail) in parts.items():
            a = got[stem] if stem in got else young[stem] if stem in young else old[stem]
            b = got[tail] if tail in got else young[tail] if tail in young else old[tail]
            got[c] = a + b
        return got

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; None is empty."""
        whole = {i: self._direct(t) for i, t in enumerate(texts) if t and self._whole(t)}
        chunked = [_chunks(_lower(t)) if t and i not in whole else [] for i, t in enumerate(texts)]
        young, old = self.young, self.old
        new = set().union(*chunked).difference(young)
        long: dict[str, bytes] = {}
        if new:
            fresh = {w: old[w] for w in new if w in old}
            fresh |= self._learn(new.difference(fresh))
            long = {w: fresh.pop(w) for w in [w for w in fresh if len(w) > LONGEST]}
            young.update(fresh)
            self.size += sum(map(len, fresh)) + sum(map(len, fresh.values())) + ENTRY_BYTES * len(fresh)
        if long:
            out = [b"".join([young[w] if w in young else long[w] for w in words]) for words in chunked]
        else:
            # one call looks all of a text's chunks up (two at least, so that it gives a tuple)
            out = [b"".join(itemgetter(*words)(young)) if len(words) > 1 else young[words[0]] if words else b"" for words in chunked]
        for i, ids in whole.items():
            out[i] = ids
        if self.size > MEMO_BYTES // 2:
            self.young, self.old, self.size = {}, young, 0
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One encoder per worker process and vocabulary file."""
    return WordIds(path)


release_before_other_work(word_ids.cache_clear)
