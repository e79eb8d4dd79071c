"""Tokenizer ids of whole texts, each distinct chunk encoded once by the tokenizers library.

A byte-level or word-end BPE tokenizer never lets a piece cross from a character
into the white space after it, so the ids of a text are the ids of its
blank-delimited chunks in a row. Chunks repeat, so a worker remembers their ids.
Texts whose white space is anything but single spaces and single line ends go
through the library whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from pageloom.llm.texts import kept

# Spark gives each core a task; threads of the library's own would only wait for each other and take CPU time.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space other than the space and the line end, as ``str.split`` sees it.
OTHER_BLANKS = [chr(c) for c in range(0x10000) if chr(c).isspace() and chr(c) not in " \n"]
ASCII_BLANKS = [c for c in OTHER_BLANKS if c.isascii()]
#: Remembered chunks of a worker, about 200 bytes each.
REMEMBERED = 1_000_000
#: Marks that, behind letters, are always pieces of their own: no merge crosses from a letter to a mark.
TAIL = ".,;:!?%$*&#|"

JOINED = 400


def is_plain(text: str) -> bool:
    """Words are parted by one space or one line end each, and nothing else is blank."""
    return (
        text[0] not in " \n"
        and text[-1] not in " \n"
        and "  " not in text
        and " \n" not in text
        and "\n " not in text
        and "\n\n" not in text
        and not any(c in text for c in (ASCII_BLANKS if text.isascii() else OTHER_BLANKS))
    )


class _Numbers(dict):
    """Numbers for chunks in the order they come up; new ones wait in ``fresh``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.fresh.append(chunk)
        return number


class ChunkEncoder:
    """Ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    ``remembered`` bounds the known chunks; beyond it those go that came up once
    since the last time, which most chunks of a large corpus do.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.keeps_blanks = bool(self._library([" "])[0])
        self.line_end = len(self._library(["\n"])[0])
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for piece, i in vocabulary.items() if (piece.startswith("Ġ") if self.keeps_blanks else suffix and piece.endswith(suffix))]] = True
        self._forget()

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.tails: dict[str, np.ndarray] = {}
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.begin, self.size, self.seen = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _forget_rare(self) -> None:
        """Keep what came up repeatedly, the most frequent half of the bound at most."""
        names, seen, begin, size, flat = list(self.numbers), self.seen[: len(self.numbers)], self.begin, self.size, self.flat
        often = np.flatnonzero(seen > 1)
        if len(often) > self.remembered // 2:
            often = np.sort(often[np.argpartition(seen[often], -(self.remembered // 2))[-(self.remembered // 2) :]])
        self._forget()
        self.numbers.update(zip([names[i] for i in often.tolist()], range(len(often))))
        self._more_numbers()
        sizes = size[often]
        starts = np.cumsum(sizes) - sizes
        at = self._room(int(sizes.sum()))
        self.flat[at : at + int(sizes.sum())] = flat[np.repeat(begin[often] - starts, sizes) + np.arange(int(sizes.sum()))]
        self.begin[: len(often)], self.size[: len(often)] = at + starts, sizes

    def _more_numbers(self) -> None:
        """Room for what is known of each numbered chunk."""
        while len(self.numbers) > len(self.begin):
            self.begin, self.size, self.seen = (np.concatenate([own, np.zeros_like(own)]) for own in (self.begin, self.size, self.seen))

    def _room(self, ids: int) -> int:
        """Make room for more ids; the place where they go."""
        at = self.used
        self.used += ids
        while self.used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        return at

    def _each(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, and how many belong to each, by a library call's text for each."""
        blank = " " if self.keeps_blanks else ""
        found = self._library([c if c[0] == "\n" else blank + c for c in chunks])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _letters(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks of letters alone, many to a text: each is one word, whose first or last piece shows it."""
        blank = " " if self.keeps_blanks else ""
        found = self._library([blank + " ".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)])
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(chunks):  # letters that are no letters any more once normalized
            return self._each(chunks)
        return ids, np.diff(edges, append=len(ids)) if self.keeps_blanks else np.diff(edges, prepend=-1)

    def _learn(self) -> None:
        """Ids of the waiting chunks; chunk i owns flat[begin[i]:begin[i] + size[i]]."""
        fresh = self.numbers.fresh
        if not fresh:
            return
        words: list[int] = []
        whole: list[int] = []
        tailed: dict[str, tuple[list[int], list[int]]] = {}
        number, first = self.numbers.__getitem__, len(self.numbers) - len(fresh)
        at = 0
        while at < len(fresh):  # cores join the waiting chunks as they come up
            chunk = fresh[at]
            if chunk.isalpha():
                words.append(at)
            else:
                core = chunk.rstrip(TAIL)
                if len(core) < len(chunk) and core.isalpha():
                    mine = tailed.setdefault(chunk[len(core) :], ([], []))
                    mine[0].append(first + at)
                    mine[1].append(number(core))
                else:
                    whole.append(at)
            at += 1
        self._more_numbers()
        for places, (ids, sizes) in (
            (words, self._letters([fresh[i] for i in words])),
            (whole, self._each([fresh[i] for i in whole])),
        ):
            begin = self._room(len(ids))
            self.flat[begin : begin + len(ids)] = ids
            at = np.array(places, np.int64) + first
            self.begin[at], self.size[at] = begin + np.cumsum(sizes) - sizes, sizes
        for tail, (chunks, cores) in tailed.items():
            if tail not in self.tails:
                self.tails[tail] = np.array(self._library([tail])[0], np.uint32)
            ids = self.tails[tail]
            from_, own = self.begin[cores], self.size[cores]
            np.add.at(self.seen, cores, 1)
            size = own + len(ids)
            start = self._room(int(size.sum())) + np.cumsum(size) - size
            within = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            self.flat[np.repeat(start, own) + within] = self.flat[np.repeat(from_, own) + within]
            self.flat[(start + own)[:, None] + np.arange(len(ids))] = ids
            self.begin[chunks], self.size[chunks] = start, size
        self.numbers.fresh = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many belong to each text."""
        if len(self.numbers) > self.remembered:
            self._forget_rare()
        runs: list[np.ndarray] = [np.empty(0, np.int64)]
        upto = np.zeros(len(texts) + 1, np.int64)
        number = self.numbers.__getitem__
        odd = []
        for i, text in enumerate(texts):
            if text and is_plain(text):
                if self.keeps_blanks:
                    words = text.replace("\n", " \n").split(" ")
                    words[0] = "\n" + words[0]
                else:
                    words = text.split()
                runs.append(np.fromiter(map(number, words), np.int64, len(words)))
                upto[i + 1] = len(words)
            elif text:
                odd.append(i)
        upto = np.cumsum(upto)
        self._learn()
        chunks = np.concatenate(runs)
        self.seen[: len(self.numbers)] += np.bincount(chunks, minlength=len(self.numbers))
        begin, size = self.begin[chunks], self.size[chunks]
        if self.keeps_blanks:  # a text's first chunk was looked up behind a line end that the text doesn't have
            leading = upto[:-1][np.diff(upto) > 0]
            begin[leading] += self.line_end
            size[leading] -= self.line_end
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        counts = np.diff(ends[upto])
        if not odd:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i, whole in zip(odd, self._library([texts[i] for i in odd]), strict=True):
            parts[i], counts[i] = np.array(whole, np.uint32), len(whole)
        return np.concatenate(parts), counts


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks."""
    return kept(f"ids of {path}", lambda: ChunkEncoder(path))
