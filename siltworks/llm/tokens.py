"""Token ids of a public tokenizer, with a memory for words."""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

#: words whose ids a worker remembers before it starts anew
CACHED_WORDS = 1_000_000

# Characters for which str.split() and the tokenizer agree on white space; other texts
# are encoded by the tokenizer as a whole.
_PLAIN = re.compile("[\t\n\r -~\xa1-ɏ‐-‧€]*")


class Encoder:
    """Token ids as little-endian bytes, by white-space separated word with a memory.

    The tokenizer never joins over white space, so a text has the ids of its words. Texts
    that hold one of the tokenizer's added tokens (end marks and the like) are encoded as
    a whole, because these are found before anything else.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(str(a.content).lower()) for a in added) or "(?!)")
        self.cached_words, self.known = cached_words, {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _learn(self, words: list[str]) -> None:
        """Encodes new words in one call; an end mark between them shows where each one stops."""
        mark = self._raw(["\n!\n"])[0]
        raw = np.frombuffer(self._raw(["\n!\n".join(words)])[0], dtype="<u4")
        stops = np.flatnonzero(raw == np.frombuffer(mark, dtype="<u4")[0]) if len(mark) == 4 else ()
        if len(stops) == len(words) - 1:
            data, at = raw.tobytes(), 0
            for word, stop in zip(words, [*(stops * 4).tolist(), len(data)]):
                self.known[word] = data[at:stop]
                at = stop + 4
        else:  # a word has the mark itself
            self.known.update(zip(words, self._raw(words)))

    def _words(self, text: str) -> list[str] | None:
        if not _PLAIN.fullmatch(text):
            return None
        text = unicodedata.normalize("NFC", text).lower()
        return None if self.added.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cached_words:
            self.known.clear()
        known = self.known
        words = [self._words(t) for t in texts]
        new = set().union(*[w for w in words if w]).difference(known)
        marked = [w for w in new if "!" in w]
        new.difference_update(marked)
        if new:
            self._learn(list(new))
        if marked:
            known.update(zip(marked, self._raw(marked)))
        return [
            b"".join(map(known.__getitem__, w)) if w is not None else self._raw([t])[0] for w, t in zip(words, texts)
        ]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process; it is kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
