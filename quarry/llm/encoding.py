"""Token ids of texts by a public tokenizer file."""

from __future__ import annotations

import json
import os
import sys
from array import array
from itertools import filterfalse

import numpy as np

from quarry.llm.common import by_bytes, worker_cache

#: Where any of these is, the cut below would not be the tokenizer's: white space other than a space or line feed.
_OTHER = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER_ASCII = [c for c in _OTHER if c.isascii()]
#: Words kept with their ids by each Python worker, beside those of the texts at hand.
CACHED_WORDS = 1_000_000
#: Words that the library gets as one text.
JOINED_WORDS = 500
#: Characters of texts whose words are looked up at once.
LOOKED_UP = 1 << 20

_POINTS = ".,;:!?%&$*#"


def _bytes(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Encoder:
    """``encode(texts)``: the ids that the tokenizers library gives for each
    whole text (no special tokens added), as little-endian uint32 bytes.

    A byte-level BPE with the usual word pattern never merges across the space
    before a word or past a single line feed, so ids of repeated words are
    looked up instead of computed anew. Texts with other white space, and
    other kinds of tokenizer, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and not spec.get("normalizer") and spec["model"].get("type") == "BPE"
                        and not spec.get("truncation")
                        and all(t["special"] and not t.get("lstrip") and not t.get("rstrip") and " " not in t["content"]
                                and "\n" not in t["content"] for t in spec.get("added_tokens", [])))
        feed = tok.encode("\n", add_special_tokens=False).ids
        self.by_word = self.by_word and len(feed) == 1
        self.tok, self.feed = tok, feed[0] if feed else -1
        self.space = self.whole([" "])[0]
        self.ids: dict[str, bytes] = {}  # of " word" under "word", of "\nword" under itself
        self.tails: dict[str, bytes] = {}  # of runs of points

    def whole(self, texts: list[str]) -> list[bytes]:
        return [_bytes(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _rows(self, lines: list[str]) -> list[bytes]:
        """Ids of many short lines that hold no line feed: some hundreds at a
        time go to the library as one text and are cut at the line feeds' ids."""
        out: list[bytes] = []
        for lo in range(0, len(lines), JOINED_WORDS):
            run = lines[lo: lo + JOINED_WORDS]
            ids = np.array(self.tok.encode_batch_fast(["\n".join(run)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.feed)).tolist()
            if len(cuts) != len(run) - 1:
                raise ValueError("the tokenizer does not cut at line feeds")
            raw = ids.tobytes()
            out += [raw[x:y] for x, y in zip([0, *[c + 4 for c in cuts]], [*cuts, len(raw)])]
        return out

    def _learn(self, new: set[str]) -> None:
        """Adds the ids of words that are not known."""
        known = self.ids
        # points after a letter are tokens of their own: the word without them is looked up in turn
        pointed = [(w, w.rstrip(_POINTS)) for w in new if w[-1] in _POINTS]
        pointed = [(w, s, w[len(s):]) for w, s in pointed if s and s[-1].isalpha() and s[-1] < "\u0250"]
        new.difference_update([w for w, _, _ in pointed])
        new.update({s for _, s, _ in pointed}.difference(known))
        spaced = [w for w in new if w[0] != "\n"]
        known.update(zip(spaced, self._rows([" " + w for w in spaced])))
        feed = np.array([self.feed], "<u4").tobytes()
        fed = [w for w in new if w[0] == "\n" and len(w) > 1]
        known.update(zip(fed, [feed + x for x in self._rows([w[1:] for w in fed])]))
        known["\n"] = feed
        if len(self.tails) > CACHED_WORDS:
            self.tails.clear()
        tails = list({t for _, _, t in pointed}.difference(self.tails))
        self.tails.update(zip(tails, self.whole(tails)))
        known.update([(w, known[s] + self.tails[t]) for w, s, t in pointed])

    def _plain(self, text: str) -> bool:
        """Whether the cut at spaces and single line feeds is the tokenizer's."""
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return False
        return not any([c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER)])

    def _looked_up(self, rests: list[str]) -> list[bytes]:
        """Ids of the words of each text, which were behind one space each.
        Arrow cuts them and numbers the different ones, so that only these are
        looked up, and puts the ids of all together."""
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        ends = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.ids
        found = list(map(known.get, different))
        missing = [k for k, x in enumerate(found) if x is None]
        if len(known) + len(missing) > CACHED_WORDS:  # words of these texts stay, most others are rare
            known = self.ids = {w: x for w, x in zip(different, found) if x is not None}
        new = {different[k] for k in missing}
        new.discard("")
        self._learn(new)
        known[""] = self.space  # stands for a space at the end of the text too
        for k in missing:
            found[k] = known[different[k]]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[ends + ids.offset].tolist()
        raw = memoryview(data) if data is not None else b""
        out = [bytes(raw[x:y]) for x, y in zip(at, at[1:])]
        pa.default_memory_pool().release_unused()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        cut, whole = [], []
        for k, text in enumerate(texts):
            if text:
                (cut if self.by_word and self._plain(text) else whole).append(k)
        for k, ids in zip(whole, self.whole([texts[k] for k in whole]) if whole else ()):
            out[k] = ids
        for run in by_bytes(cut, lambda k: len(texts[k]), LOOKED_UP):
            # a line feed becomes a word's mark, so that one cut and one look-up do for both kinds of word
            split = [texts[k].replace("\n", " \n").partition(" ") for k in run]
            for k, ids in zip(run, self.whole([head for head, _, _ in split])):
                out[k] = ids
            more = [(k, rest) for k, (_, space, rest) in zip(run, split) if space]
            if more:
                for (k, _), ids in zip(more, self._looked_up([rest for _, rest in more])):
                    out[k] += ids
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; it is loaded once."""
    cache = worker_cache()
    key = f"encoder:{path}"
    if key not in cache:
        cache[key] = Encoder(path)
    return cache[key]


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
