"""Encoding texts with a public tokenizer, word by word.

The tokenizer drops white space and never joins characters across it, so the ids of a
text are the ids of its white-space-separated words in order. Each Python worker keeps
the ids of words that it has met in a table of bounded size and hands only new words to
the tokenizers library, many in one call.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Words kept by one worker, in two tables: when the newer one is full it becomes the older one, and words still in use move over.
MAX_WORDS = 600_000
#: Longer words are encoded each time and not kept.
MAX_WORD_BYTES = 64
#: New words handed to the library in one call.
CALL_WORDS = 1 << 14

#: Letters and then marks: two runs of tokens. No apostrophe (contractions) and no < (special tokens).
LETTERS_MARKS = re.compile(rb"([a-z]+)([!-&(-/:;=-@\[-`{-~]+)")
MARKS = bytes(range(33, 127)).translate(None, b"'<" + bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)))
PROBES = [("Word, WORD. x", "word , word . x"), ("ÀB. É,", "Àb. É,"), ("the.\n**", "the . **"), ("thee!!", "thee !!")]


def default_path() -> str:
    """The public vocabulary file; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _calls(words: list) -> list[list]:
    return [words[at : at + CALL_WORDS] for at in range(0, len(words), CALL_WORDS)]


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share an executor's cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        #: The vocabulary makes no difference of case, and ends a token between letters and marks.
        self.folds = all(self.whole(a) == self.whole(b) for a, b in PROBES)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_joined(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that meet the library as one text, cut at the words' offsets."""
        texts = [w.decode("utf-8") for w in words]
        encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoding.ids, "<u4")
        starts = np.fromiter((a for a, _ in encoding.offsets), np.int64, len(ids))
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        cuts = np.searchsorted(starts, first).tolist()
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(cuts, [*cuts[1:], len(ids)])]

    def _encode_letters(self, texts: list[str]) -> list[bytes] | None:
        """Ids of words of letters only: one token each has the end-of-word mark, so no offsets are needed."""
        encoding = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0]
        ids = np.array(encoding.ids, "<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(cuts) != len(texts) or cuts[-1] != len(ids):
            return None
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def _held(self, ids: bytes):
        """What is kept of a word."""
        return ids

    def _plain(self, word: bytes) -> bytes:
        """Ids of lower-case ASCII letters, which need no normalising or splitting."""
        return array("I", [t.id for t in self.tokenize(word.decode("ascii"))]).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        kept, others = self.ids, []
        for w in words:
            if not self.folds:
                others.append(w)
            elif w.isalpha() and w.islower():
                if w not in kept:
                    kept[w] = self._plain(w)
            elif marked := LETTERS_MARKS.fullmatch(w):
                letters, marks = marked.groups()
                for part in (letters, marks):
                    if part not in kept:
                        kept[part] = self._plain(part) if part is letters else self._held(self.whole(part.decode("ascii")))
                kept[w] = kept[letters] + kept[marks]
            else:
                others.append(w)
        texts = [w.decode("utf-8") for w in others]
        plain = [t.isalpha() and t.lower().isalpha() for t in texts]
        for part in _calls([(w, t) for w, t, x in zip(others, texts, plain) if x]):
            found = self._encode_letters([t for _, t in part]) or self._encode_joined([w for w, _ in part])
            kept.update(zip((w for w, _ in part), map(self._held, found)))
        for part in _calls([w for w, x in zip(others, plain) if not x]):
            kept.update(zip(part, map(self._held, self._encode_joined(part))))

    def _split(self, text: str | bytes | None) -> list[bytes]:
        if not text:
            return []
        data = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
        if self.folds and b"<|" not in data:  # else a special token's string might arise
            data = data.lower()
        return data.split()

    def encode_many(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Ids of whole texts (UTF-8 where they are bytes); null has none. New words of all texts meet the library together."""
        out, at = [], 0
        while at < len(texts):
            lists, distinct = [], set()
            while at < len(texts) and len(distinct) < MAX_WORDS // 8:
                lists.append(self._split(texts[at]))
                distinct.update(lists[-1])
                at += 1
            if len(distinct) > MAX_WORDS // 4 or max(map(len, distinct), default=0) > MAX_WORD_BYTES:
                out += [self._one(words) for words in lists]
                continue
            self._prepare(distinct)
            ids = self.ids.__getitem__
            out += [b"".join(map(ids, words)) for words in lists]
        return out

    def _prepare(self, distinct: set[bytes]) -> None:
        new = distinct.difference(self.ids)
        if new:
            if len(self.ids) + len(new) > MAX_WORDS // 2:
                self.ids, self.older = {}, self.ids
                new = distinct
            known = {w: self.older[w] for w in new if w in self.older}
            self.ids.update(known)
            self._learn(list(new.difference(known)))

    def _one(self, words: list[bytes]) -> bytes:
        distinct = set(words)
        if len(distinct) > MAX_WORDS // 4 or max(map(len, distinct), default=0) > MAX_WORD_BYTES:
            return self._pieces(words)
        self._prepare(distinct)
        return b"".join(map(self.ids.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def _pieces(self, words: list[bytes]) -> bytes:
        """A text with very long or very many new words: in slices, without keeping its words."""
        out = []
        for at in range(0, len(words), 1 << 15):
            out.append(self.whole(" ".join(w.decode("utf-8") for w in words[at : at + (1 << 15)])))
        return b"".join(out)


class WordCounter(WordEncoder):
    """Numbers of ids only: of a word its number is kept, and no text's ids are put together."""

    def __init__(self, path: str):
        super().__init__(path)
        self.marks: dict[bytes, int] = {}
        #: Other letters are parted from marks as well.
        self.parts = self.folds and all(self.whole(a) == self.whole(b) for a, b in [("éa.", "éa ."), ("cañón!!", "cañón !!")])

    def _held(self, ids: bytes) -> int:
        return len(ids) // 4

    def _learn(self, words: list[bytes]) -> None:
        if not self.parts:
            return super()._learn(words)
        kept, tokenize, marked, letters, others = self.ids, self.tokenize, [], set(), []
        for w in words:
            stem = w.rstrip(MARKS)
            if stem.isalpha() and stem.islower():
                if stem not in kept:
                    kept[stem] = len(tokenize(stem.decode("ascii")))
            elif (text := stem.decode("utf-8")).isalpha() and text.lower().isalpha():
                if stem not in kept:
                    letters.add(stem)
            else:
                others.append(w)
                continue
            if len(stem) < len(w):
                marked.append((w, stem))
        for part in _calls([*letters]):
            found = self._encode_letters([x.decode("utf-8") for x in part]) or self._encode_joined(part)
            kept.update(zip(part, map(self._held, found)))
        for part in _calls(others):
            kept.update(zip(part, map(self._held, self._encode_joined(part))))
        for w, stem in marked:
            marks = w[len(stem) :]
            if (n := self.marks.get(marks)) is None:
                n = len(self.whole(marks.decode("ascii"))) // 4
                if len(self.marks) < CALL_WORDS:
                    self.marks[marks] = n
            kept[w] = kept[stem] + n

    def _plain(self, word: bytes) -> int:
        return len(self.tokenize(word.decode("ascii")))

    def _numbers(self, words: list[bytes]) -> list[int]:
        """Of a text with very long or very many new words: in slices; very long words are encoded each time."""
        out = []
        for at in range(0, len(words), 1 << 15):
            part = words[at : at + (1 << 15)]
            self._prepare({w for w in part if len(w) <= MAX_WORD_BYTES})
            out += [self.ids[w] if len(w) <= MAX_WORD_BYTES else len(self.whole(w.decode("utf-8"))) // 4 for w in part]
        return out

    def count_runs(self, texts: list[str | bytes | None], run: int) -> list[list[int]]:
        """Numbers of ids of each text, by runs of so many words; a text without words has none."""
        out, at = [], 0
        while at < len(texts):
            lists, distinct = [], set()
            while at < len(texts) and len(distinct) < MAX_WORDS // 8:
                lists.append(self._split(texts[at]))
                distinct.update(lists[-1])
                at += 1
            if len(distinct) > MAX_WORDS // 4 or max(map(len, distinct), default=0) > MAX_WORD_BYTES:
                found = map(self._numbers, lists)
            else:
                self._prepare(distinct)
                number = self.ids.__getitem__
                found = (list(map(number, words)) for words in lists)
            out += [[sum(x[k : k + run]) for k in range(0, len(x), run)] for x in found]
        return out


_encoders: dict[str, WordEncoder] = {}
_counters: dict[str, WordCounter] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder by Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def counter(path: str) -> WordCounter:
    """One counter by Python worker and vocabulary."""
    if path not in _counters:
        _counters[path] = WordCounter(path)
    return _counters[path]
