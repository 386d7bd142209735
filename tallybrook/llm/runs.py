"""Tokens of whole texts out of a table of short runs.

A text is cut before every single space that stands between two characters other than
white space (or U+2581, which sentencepiece takes for one). The tokenizers used here
always begin anew at such a space and never look across it, so the tokens of the runs,
put together, are the tokens of the text. Texts repeat most of their runs: a worker
encodes a run once, and keeps a bounded number of them.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import cache, wraps
from itertools import compress, count

import numpy as np
import pyarrow as pa

_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
# White space other than space and line feed.
_RARE_ASCII = "\t\r\v\f\x1c\x1d\x1e\x1f"
_RARE = re.compile(r"[\t\r\v\f\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000▁]")


_held: dict = {}


def held(make: Callable) -> Callable:
    """What ``make`` gives for its arguments, kept by the worker for its next tasks, until
    another table is asked for: workers outlive stages, and tables of several operators
    would add up."""

    @wraps(make)
    def get(*args):
        key = (make.__module__, make.__qualname__, *args)
        if key not in _held:
            _held.clear()
            # Memory of earlier batches would stay with the worker beside the new table.
            pa.default_memory_pool().release_unused()
            _held[key] = make(*args)
        return _held[key]

    return get


def let_go() -> None:
    """Give back what the worker holds for tasks before this one: tables, vocabularies, and
    memory that is free but not returned. For tasks that need none of it."""
    _held.clear()
    load_tokenizer.cache_clear()
    load_pieces.cache_clear()
    pa.default_memory_pool().release_unused()
    # glibc keeps what is freed below its top; other C libraries have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def runs(text: str) -> list[str]:
    """The text cut as above; every run but the first has lost its leading space."""
    risky = (
        "  " in text or " \n" in text or "\n " in text or text[:1].isspace() or text[-1:].isspace()
        or (any(x in text for x in _RARE_ASCII) if text.isascii() else _RARE.search(text))
    )
    return _CUT.split(text) if risky else text.split(" ")


def text_runs(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The runs of all texts on end, those that open a text with a space put before them, which
    no other run begins with; and the first of each text (one more than texts)."""
    flat: list[str] = []
    first = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        cut = runs(text)
        cut[0] = " " + cut[0]
        flat += cut
        first[i + 1] = len(flat)
    return flat, first


class RunTable:
    """What ``encode_many`` gives for runs, for at most ``limit`` of them besides those in
    ``fixed``. A table that is full starts anew, so its memory is bounded."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable], limit: int = 1_000_000, fixed: dict | None = None):
        self.encode_many, self.limit, self.fixed = encode_many, limit, fixed or {}
        self.known = dict(self.fixed)

    def keep(self, fixed: dict) -> None:
        """Hold these entries for good from now on."""
        if fixed is not self.fixed:
            self.fixed = fixed
            self.known.update(fixed)

    def values(self, found: list[str]) -> list:
        values = list(map(self.known.get, found))
        if None not in values:
            return values
        missing = list({found[i] for i, v in enumerate(values) if v is None})
        if len(self.known) + len(missing) > self.limit + len(self.fixed):
            self.known = dict(self.fixed)
        fresh = dict(zip(missing, self.encode_many(missing)))
        self.known.update(fresh)
        return [fresh[found[i]] if v is None else v for i, v in enumerate(values)]


@cache
def load_tokenizer(path: str):
    """A tokenizers file, as the library handles it by default; one thread per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def load_pieces(path: str):
    """A sentencepiece file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class ByteBpe:
    """Ids of runs from a byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        size = self.tokenizer.get_vocab_size()
        # Byte-level vocabularies write a space as U+0120; no token has one further in.
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.width = np.uint16 if size <= 1 << 16 else np.uint32

    def openers(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts as they are."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(x.ids, self.width) for x in found]

    def _as_one(self, found: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of runs encoded as one text, which costs half as much, and the first of each.
        Only the first token of a run begins with a space, as runs hold none between other
        characters; None where that does not hold."""
        text = " " + " ".join(found)
        if "  " in text or text.endswith(" ") or text.count(" ") != len(found):
            return None
        ids = self.openers([text])[0]
        cuts = np.flatnonzero(self.spaced[ids])
        return (ids, cuts) if len(cuts) == len(found) and cuts[0] == 0 else None

    def followers(self, found: list[str]) -> list[np.ndarray]:
        """Ids of runs with their leading space back."""
        if not found:
            return []
        whole = self._as_one(found)
        return self.openers([" " + x for x in found]) if whole is None else np.split(whole[0], whole[1][1:])

    def joined(self, opening: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these runs on end, the first ones as they are, and how many each has."""
        whole = self._as_one(other) if other else None
        found = self.openers(opening if whole else opening + [" " + x for x in other])
        ids, lengths = [*found], [np.array([len(x) for x in found], np.int64)]
        if whole:
            ids.append(whole[0])
            lengths.append(np.diff(whole[1], append=len(whole[0])))
        return np.concatenate([np.zeros(0, self.width), *ids]), np.concatenate(lengths)


class TextRuns:
    """The runs of texts and what ``value`` makes of their token ids."""

    def __init__(self, encode: Callable[[list[str], list[str]], list], limit: int = 1_000_000):
        self.table = RunTable(lambda found: self._encode(encode, found), limit)

    @staticmethod
    def _encode(encode, found: list[str]) -> list:
        """``encode`` gets the runs that open a text and the others; the first are told
        by a space put before them, which no other run begins with."""
        opening = [x.startswith(" ") for x in found]
        values = iter(encode([x[1:] for x in found if x.startswith(" ")], [x for x in found if not x.startswith(" ")]))
        out: list = [None] * len(found)
        for wanted in (True, False):
            for i, is_opening in enumerate(opening):
                if is_opening is wanted:
                    out[i] = next(values)
        return out

    def values(self, texts: list[str]) -> tuple[list, np.ndarray]:
        """Values of all runs of the texts on end, and the first of each text (one more
        than texts)."""
        flat, first = text_runs(texts)
        return self.table.values(flat), first


class RunPool:
    """Runs as places in pools: their ids on end, and a number each. A text's ids are gathered,
    not put together from objects. A run that is looked up and not known gets the next place.
    A pool with ``limit`` runs or more keeps those that were in the most calls, half of that,
    so it holds ``limit`` runs and those of one call at most.

    ``encode`` gets the runs that open a text and the others, and gives the ids of all of them
    on end, how many each has, and the numbers.
    """

    def __init__(self, encode: Callable[[list[str], list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], limit: int, width=np.uint16):
        self.encode, self.limit = encode, limit
        # Runs in the order of their places; arrays may have room for more.
        self.known = self._places({}, 0)
        self.ids, self.n_ids, self.n = np.zeros(1 << 16, width), 0, 0
        self.starts, self.numbers, self.uses = (np.zeros(1 << 14, kind) for kind in (np.int64, np.int32, np.int32))

    @staticmethod
    def _places(known: Iterable, n: int) -> defaultdict[str, int]:
        return defaultdict(count(n).__next__, known)

    @staticmethod
    def _room(pool: np.ndarray, size: int) -> np.ndarray:
        return pool if size <= len(pool) else np.concatenate((pool, np.zeros(size - len(pool) + len(pool) // 4, pool.dtype)))

    def _add(self, fresh: list[str]) -> None:
        """``fresh`` are the runs that have got the next places, in their order."""
        opens = np.array([x.startswith(" ") for x in fresh])
        ids, lengths, numbers = self.encode([x[1:] for x in fresh if x.startswith(" ")], [x for x in fresh if not x.startswith(" ")])
        # Out of the order in which they were encoded.
        order = np.empty(len(fresh), np.int64)
        order[np.concatenate((np.flatnonzero(opens), np.flatnonzero(~opens)))] = np.arange(len(fresh))
        begins = (np.cumsum(lengths) - lengths)[order]
        lengths, numbers = lengths[order], numbers[order]
        n, upto, n_ids = self.n, self.n + len(lengths), self.n_ids + len(ids)
        self.ids, self.starts = self._room(self.ids, n_ids), self._room(self.starts, upto + 1)
        self.numbers, self.uses = self._room(self.numbers, upto), self._room(self.uses, upto)
        ends = np.cumsum(lengths)
        self.ids[self.n_ids : n_ids] = ids[np.arange(len(ids)) + np.repeat(begins - (ends - lengths), lengths)]
        self.starts[n + 1 : upto + 1] = self.n_ids + ends
        self.numbers[n:upto], self.uses[n:upto] = numbers, 0
        self.n, self.n_ids = upto, n_ids

    def _trim(self) -> None:
        n, kept = self.n, self.limit // 2
        stays = np.zeros(n, bool)
        stays[np.argpartition(self.uses[:n], n - kept)[n - kept :]] = True
        lengths = np.diff(self.starts[: n + 1])
        self.known = self._places(zip(compress(self.known, stays.tolist()), range(kept)), kept)
        ids = self.ids[: self.n_ids][np.repeat(stays, lengths)]
        self.n, self.n_ids = kept, len(ids)
        self.ids[: len(ids)] = ids
        self.starts[1 : kept + 1] = np.cumsum(lengths[stays])
        self.numbers[:kept] = self.numbers[:n][stays]
        # What was used long ago counts less.
        self.uses[:kept] = self.uses[:n][stays] // 2

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts on end, where each text's begin (one more than texts); the
        numbers of all runs on end, and where each text's begin."""
        if self.n >= self.limit:
            self._trim()
        flat, first = text_runs(texts)
        places = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        at = np.flatnonzero(places >= self.n)
        if len(at):
            self._add([flat[i] for i in at[np.unique(places[at], return_index=True)[1]].tolist()])
        self.uses[places] += 1
        begins = self.starts[places]
        lengths = self.starts[places + 1] - begins
        upto = np.concatenate(([0], np.cumsum(lengths)))
        inside = np.arange(upto[-1]) + np.repeat(begins - upto[:-1], lengths)
        return self.ids[inside], upto[first], self.numbers[places].astype(np.int64), first


def byte_bpe_runs(path: str, value: Callable[[np.ndarray], object], limit: int = 1_000_000) -> TextRuns:
    """Runs encoded by a byte-level vocabulary of the tokenizers library."""
    bpe = ByteBpe(path)
    return TextRuns(lambda opening, other: [value(x) for x in bpe.openers(opening) + bpe.followers(other)], limit)
