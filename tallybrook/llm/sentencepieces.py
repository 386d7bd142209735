"""SentencePiece encoding with seeded merge-dropout, and decoding.

A run of text (a word with its leading space) starts as single characters. An agenda
holds the neighbouring symbols that form a piece, best piece first. A candidate that
comes up is skipped at the dropout rate, by draws keyed with seed, document, copy and
place: every occurrence of a run draws its own path, and reruns repeat them. With rate 0
the ids are those of the sentencepiece library.

A worker keeps the path without skips of the runs it has met. An occurrence draws how many
candidates come up before the first skip; where that is no more than the path has, it is
merged anew, thousands of occurrences at once as columns of arrays. Runs of more than
``COLUMN_SYMBOLS`` symbols are rare: they are merged one by one, and a keyed hash of where
a candidate lies tells whether it is skipped.

Defined cases: NULL gives NULL both ways; the empty text has no ids; a character without a
piece, and U+2581 itself, becomes byte pieces, so every text comes back as it was; texts
of any length are encoded whole; repeated rows with one id get the same ids, unless
``copy_column`` tells them apart; rows with a NULL id draw by their text; an empty table
gives an empty result. Other columns are kept; those this module adds replace
columns of the same name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.runs import held, load_pieces, runs
from tallybrook.llm.words import mix, pieces

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
MASK = (1 << 64) - 1
NEVER = float("inf")

# Symbols up to which runs are merged as columns. A run of n symbols has less than 3 n
# candidates.
COLUMN_SYMBOLS = 17
GAPS = 3 * COLUMN_SYMBOLS

# Columns at once, and the numbers for a place in them: below this is the place, above it
# the rank.
COLUMNS, PLACES = 1 << 14, 32
NO_PIECE, NO_PAIR, NO_MERGE = 0xFFFF, np.uint32(0xFFFFFFFF), np.int32(1 << 30)

# Runs a worker keeps.
WORKER_RUNS = 150_000

# Rows decoded at once.
ROWS_AT_ONCE = 256

# Symbols up to which a list is the faster agenda.
FEW_SYMBOLS = 48


class Vocabulary:
    """Ids and ranks of pieces, byte pieces, and the bytes each id stands for."""

    def __init__(self, path: str):
        model = load_pieces(path)
        size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
        self.ids = {name: i for i, (name, use) in enumerate(zip(names, plain)) if use}
        scores = {name: model.get_score(i) for name, i in self.ids.items()}
        # A smaller rank merges first.
        self.ranks = {name: -score for name, score in scores.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [name.replace(SPACE, " ").encode() if use else b"" for name, use in zip(names, plain)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])


@cache
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def skipped(word: int, left: int, end: int, limit: int) -> bool:
    """Whether a candidate is skipped: a hash of the keyed run and of where it lies."""
    return ((word ^ (left * 0x9E3779B97F4A7C15 + end * 0xC2B2AE3D27D4EB4F)) * 0xBF58476D1CE4E5B9) & MASK < limit


def symbols_of(run: str) -> list[str]:
    """The characters of a run behind its leading space."""
    if SPACE in run or " " in run:
        # A literal U+2581 must not look like a space: U+0000 stands in for it, which has
        # no piece of its own either.
        return [SPACE, *(SPACE if c == " " else "\0" if c == SPACE else c for c in run)]
    return [SPACE, *run]


def ids_of(run: str, symbols: list[str], vocabulary: Vocabulary) -> list[int]:
    """Ids of the symbols a run was merged to."""
    known = vocabulary.ids
    out = list(map(known.get, symbols))
    if None not in out and "\0" not in run:
        return out
    out, at, origin = [], 0, SPACE + run
    for symbol in symbols:
        piece = known.get(symbol) if symbol != "\0" else None
        if piece is None:
            out.extend(vocabulary.byte_ids[b] for b in origin[at].encode())
        else:
            out.append(piece)
        at += len(symbol)
    return out


def segment(run: str, vocabulary: Vocabulary, rate: float = 0.0, key: int = 0) -> list[int]:
    """Ids of one run, to which its leading space has been restored."""
    symbols = symbols_of(run)
    limit = int(rate * (1 << 64))
    word = xxhash.xxh3_64_intdigest(run.encode(), key & MASK) if limit else 0
    merge = _merge_few if len(symbols) <= FEW_SYMBOLS else _merge_many
    return ids_of(run, merge(symbols, vocabulary.ranks, word, limit), vocabulary)


def _merge_few(symbols: list[str], ranks: dict[str, float], word: int, limit: int) -> list[str]:
    """The agenda as a list: the rank of every neighbouring pair. Best for short runs."""
    rank_of = ranks.get
    starts = list(range(len(symbols) + 1))
    agenda = [rank_of(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
    while agenda:
        best = min(agenda)
        if best == NEVER:
            break
        i = agenda.index(best)
        if limit and skipped(word, starts[i], starts[i + 2], limit):
            agenda[i] = NEVER
            continue
        merged = symbols[i] + symbols.pop(i + 1)
        symbols[i] = merged
        del starts[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = rank_of(merged + symbols[i + 1], NEVER)
        if i:
            agenda[i - 1] = rank_of(symbols[i - 1] + merged, NEVER)
    return symbols


def _merge_many(symbols: list[str], ranks: dict[str, float], word: int, limit: int) -> list[str]:
    """The agenda as a heap of (rank, left, end), for runs of any length."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    ends = list(range(1, n + 1))
    agenda = []
    for i in range(n - 1):
        rank = ranks.get(symbols[i] + symbols[i + 1])
        if rank is not None:
            agenda.append((rank, i, i + 2))
    heapq.heapify(agenda)
    while agenda:
        _, left, end = heapq.heappop(agenda)
        right = after[left]
        # Out of date: a symbol of the candidate has been merged otherwise.
        if not symbols[left] or right >= n or ends[right] != end:
            continue
        if limit and skipped(word, left, end, limit):
            continue
        merged = symbols[left] + symbols[right]
        symbols[left], symbols[right] = merged, ""
        ends[left] = end
        after[left] = follows = after[right]
        if follows < n:
            before[follows] = left
            rank = ranks.get(merged + symbols[follows])
            if rank is not None:
                heapq.heappush(agenda, (rank, left, ends[follows]))
        leads = before[left]
        if leads >= 0:
            rank = ranks.get(symbols[leads] + merged)
            if rank is not None:
                heapq.heappush(agenda, (rank, leads, end))
    return [x for x in symbols if x]


class Pool:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.size = np.zeros(1 << 12, kind), 0

    def put(self, values, keep: bool = True) -> int:
        """Append values and give the place of the first; the next call writes over them
        unless they are to be kept."""
        at, upto = self.size, self.size + len(values)
        if upto > len(self.data):
            self.data = np.concatenate((self.data[:at], np.zeros(upto - at + upto // 2, self.data.dtype)))
        self.data[at:upto] = values
        if keep:
            self.size = upto
        return at


class Gaps:
    """How many candidates come up before one is skipped, out of a 64-bit draw."""

    def __init__(self, rate: float):
        self.fixed = None if 0 < rate < 1 else 0 if rate >= 1 else GAPS
        # At most so many of 2 ** 64 draws skip none of k + 1 candidates, fewest first.
        self.none_of = np.array([int((1 - rate) ** k * (1 << 53)) << 11 for k in range(GAPS, 0, -1)], np.uint64) if self.fixed is None else None

    def of(self, draws: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(draws), self.fixed, np.int64)
        return GAPS - np.searchsorted(self.none_of, draws, "right")


class Columns:
    """Merging of many runs at once: a run is a column, a symbol a place in it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, ids = vocabulary, vocabulary.ids
        order = {rank: n for n, rank in enumerate(sorted(set(vocabulary.ranks.values())))}
        parts = {}
        for name, number in ids.items():
            for k in range(1, len(name)):
                if name[:k] in ids and name[k:] in ids:
                    parts[ids[name[:k]] << 16 | ids[name[k:]]] = number, order[vocabulary.ranks[name]] * PLACES
        pairs = np.array(list(parts), np.uint32)
        merged, codes = np.array(list(parts.values()), np.int64).reshape(-1, 2).T
        # A table by hash; a pair whose slot is taken goes to the next one.
        self.bits = max(10, len(pairs).bit_length() + 2)
        self.pairs = np.full(1 << self.bits, NO_PAIR, np.uint32)
        self.merged, self.codes = np.zeros(1 << self.bits, np.uint32), np.full(1 << self.bits, NO_MERGE, np.int32)
        rest, slots = np.arange(len(pairs)), self._slots(pairs)
        while len(rest):
            free = self.pairs[slots] == NO_PAIR
            self.pairs[slots[free]] = pairs[rest[free]]
            placed = self.pairs[slots] == pairs[rest]
            self.merged[slots[placed]], self.codes[slots[placed]] = merged[rest[placed]], codes[rest[placed]]
            rest, slots = rest[~placed], (slots[~placed] + 1) & ((1 << self.bits) - 1)
        self.symbol_of = np.full(0x110000, NO_PIECE, np.uint32)
        for name, number in ids.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = number
        self.space = ids.get(SPACE, NO_PIECE)
        # U+2581 itself must not look like a space.
        self.symbol_of[[ord(" "), ord(SPACE), 0]] = self.space, NO_PIECE, NO_PIECE

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def _slot_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slots of pairs of neighbouring symbols, or one that is free."""
        wanted = left << np.uint32(16) | right
        slots = self._slots(wanted)
        found = self.pairs[slots]
        astray = np.flatnonzero((found != wanted) & (found != NO_PAIR))
        while len(astray):
            slots[astray] = (slots[astray] + 1) & ((1 << self.bits) - 1)
            found = self.pairs[slots[astray]]
            astray = astray[(found != wanted[astray]) & (found != NO_PAIR)]
        return slots

    def merge(self, found: list[str], gaps: Gaps, draws: np.ndarray, skip_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all runs on end, how many each has, and the candidates that came up.
        ``skip_at`` counts those before the first skip, out of ``draws``."""
        n = len(found)
        sizes = np.fromiter(map(len, found), np.int64, n)
        rows = int(sizes.max()) + 1
        letters = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
        place = np.arange(1, len(letters) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # A last row without a piece stands behind the last symbol and before the first.
        symbols = np.full((rows + 1, n), NO_PIECE, np.uint32)
        symbols[0] = self.space
        symbols[place, np.repeat(np.arange(n), sizes)] = self.symbol_of[letters]
        every = np.arange(rows, dtype=np.int32)[:, None]
        left = every <= sizes
        after = np.broadcast_to(np.arange(1, rows + 2, dtype=np.int8)[:, None], (rows + 1, n)).copy()
        before = after - np.int8(2)
        before[0] = rows
        codes = np.full((rows + 1, n), NO_MERGE, np.int32)
        starts = np.flatnonzero(every < sizes)
        slots = self._slot_of(symbols.ravel()[starts], symbols.ravel()[starts + n])
        codes.ravel()[starts] = self.codes[slots] + (starts // n).astype(np.int32)
        turns, skip_at, draws = np.zeros(n, np.int64), skip_at.copy(), draws.copy()
        columns, turn = np.arange(n), 0
        while True:
            best = codes.min(axis=0)
            live = np.flatnonzero(best < NO_MERGE)
            if not len(live):
                break
            if len(live) < 0.8 * len(columns):
                columns, codes, best = columns[live], codes[:, live], best[live]
                live = np.arange(len(columns))
            else:
                best = best[live]
            i, own = best % PLACES, columns[live]
            turns[own] += 1
            skipping = skip_at[own] == turn
            turn += 1
            out = np.flatnonzero(skipping)
            if len(out):
                codes[i[out], live[out]] = NO_MERGE
                draws[own[out]] = again = mix(draws[own[out]] + np.uint64(0x9E3779B97F4A7C15))
                skip_at[own[out]] = turn + gaps.of(again)
            taken = np.flatnonzero(~skipping)
            i, own, live = i[taken], own[taken], live[taken]
            right = after[i, own]
            follows, leads = after[right, own], before[i, own]
            symbols[i, own] = merged = self.merged[self._slot_of(symbols[i, own], symbols[right, own])]
            left[right, own] = False
            after[i, own] = follows
            before[follows, own] = i
            codes[right, live] = NO_MERGE
            codes[i, live] = self.codes[self._slot_of(merged, symbols[follows, own])] + i
            codes[leads, live] = self.codes[self._slot_of(symbols[leads, own], merged)] + leads
        lengths = left.sum(axis=0)
        ids = symbols[:-1].T[left.T]
        if (ids == NO_PIECE).any():
            ids, lengths = self._with_bytes(found, ids, lengths, left)
        return ids, lengths, turns

    def _with_bytes(self, found, ids, lengths, left) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece, which are single characters, as byte pieces."""
        byte_ids, (owners, places) = self.vocabulary.byte_ids, np.nonzero(left.T)
        lacking = np.flatnonzero(ids == NO_PIECE)
        origins = [(SPACE + found[o])[p].encode() for o, p in zip(owners[lacking].tolist(), places[lacking].tolist())]
        sizes = np.ones(len(ids), np.int64)
        sizes[lacking] = [len(x) for x in origins]
        out = np.repeat(ids, sizes)
        out[np.repeat(np.isin(np.arange(len(ids)), lacking), sizes)] = [byte_ids[b] for x in origins for b in x]
        return out, np.bincount(owners, sizes, len(found)).astype(np.int64)


@cache
def columns_of(path: str) -> Columns:
    return Columns(vocabulary_of(path))


class Paths:
    """Ids of occurrences of runs. The path without skips is kept of at most ``limit`` runs
    besides those of a batch; a table that is full starts anew."""

    def __init__(self, path: str, rate: float, limit: int):
        self.columns, self.rate, self.gaps, self.limit = columns_of(path), rate, Gaps(rate), limit
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = Pool(np.uint16)
        # Of each run: its place in the ids, how many it has, the candidates that come up.
        self.at, self.length, self.turns = Pool(np.int64), Pool(np.int32), Pool(np.int16)

    def _learn(self, names: list[str]) -> None:
        for k in range(0, len(names), COLUMNS):
            some = names[k : k + COLUMNS]
            never = np.full(len(some), GAPS, np.int64)
            ids, lengths, turns = self.columns.merge(some, self.gaps, never.view(np.uint64), never)
            first = self.at.put(self.ids.put(ids) + np.cumsum(lengths) - lengths)
            self.length.put(lengths)
            self.turns.put(turns)
            self.known.update(zip(some, range(first, first + len(some))))

    def of(self, found: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all runs on end, and how many each has, given a draw per run."""
        if len(self.known) > self.limit:
            self._empty()
        node = np.fromiter(map(self.known.get, found, repeat(-1)), np.int64, len(found))
        absent = np.flatnonzero(node < 0)
        if len(absent):
            names = [found[i] for i in absent.tolist()]
            self._learn(sorted({x for x in names if len(x) < COLUMN_SYMBOLS}, key=len))
            node[absent] = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        long = np.flatnonzero(node < 0)
        skip_at = self.gaps.of(draws)
        anew = np.flatnonzero((node >= 0) & (skip_at < self.turns.data[node]))
        at, lengths = self.at.data[node], self.length.data[node].astype(np.int64)
        # What only this batch needs stands behind the kept ids, for now.
        anew = anew[np.argsort(self.turns.data[node[anew]], kind="stable")]
        own, places, sizes = [], [], []
        for k in range(0, len(anew), COLUMNS):
            some = anew[k : k + COLUMNS]
            ids, size, _ = self.columns.merge([found[i] for i in some.tolist()], self.gaps, draws[some], skip_at[some])
            own, places, sizes = [*own, ids], [*places, some], [*sizes, size]
        if len(long):
            singly = [segment(found[i], self.columns.vocabulary, self.rate, key) for i, key in zip(long.tolist(), draws[long].tolist())]
            own, places = [*own, [i for x in singly for i in x]], [*places, long]
            sizes.append(np.array([len(x) for x in singly], np.int64))
        if own:
            where, size = np.concatenate(places), np.concatenate(sizes)
            at[where] = self.ids.put(np.concatenate(own), keep=False) + np.cumsum(size) - size
            lengths[where] = size
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - ends + lengths, lengths)
        return self.ids.data[places], lengths


@held
def worker_paths_of(path: str, rate: float, limit: int) -> Paths:
    """The worker's own table; it stays for all tasks the worker runs."""
    return Paths(path, rate, limit)


def encode_texts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    ids_column: str = "ids",
    rate: float = 0.1,
    seed: int = 17,
    vocabulary: str = VOCABULARY,
    worker_runs: int = WORKER_RUNS,
    copy_column: str | None = None,
) -> DataFrame:
    """The documents with the ids of their whole texts as an array of ints. Rows of one id
    that differ in ``copy_column`` draw apart."""
    documents = documents.drop(ids_column)
    texts = documents.columns.index(text_column)
    nameless = F.when(F.col(id_column).isNull(), F.col(text_column))
    copies = [F.col(copy_column)] if copy_column else []
    keyed = documents.withColumn("_key", F.xxhash64(F.lit(seed), F.col(id_column), nameless, *copies))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_paths_of(vocabulary, rate, worker_runs)
        for batch in batches:
            for at, upto in pieces(batch.column(texts)):
                part = batch.slice(at, upto - at)
                flat: list[str] = []
                first = [0]
                for text in part.column(texts).to_pylist():
                    flat += runs(text) if text else ()
                    first.append(len(flat))
                owner = np.repeat(part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64), np.diff(first))
                place = np.arange(len(flat), dtype=np.uint64) - np.repeat(np.array(first[:-1], np.uint64), np.diff(first))
                chance = mix(owner + place * np.uint64(0x9E3779B97F4A7C15))
                found, lengths = table.of(flat, chance)
                cuts = np.concatenate(([0], np.cumsum(lengths)))[first]
                ids = pa.array(found.astype(np.int32))
                absent = np.append(part.column(texts).is_null().to_numpy(zero_copy_only=False), False)
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32), mask=absent), ids)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], ids_column])

    return keyed.mapInArrow(encode, ", ".join([*names, f"`{ids_column}` array<int>"]))


def decode_ids(
    rows: DataFrame, ids_column: str = "ids", text_column: str = "decoded", vocabulary: str = VOCABULARY
) -> DataFrame:
    """The rows with the texts their ids stand for."""
    rows = rows.drop(text_column)
    place = rows.columns.index(ids_column)
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stands_for = vocabulary_of(vocabulary).bytes.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [
                    None if ids is None else b"".join(map(stands_for, ids))[1:].decode() for ids in _lists(part.column(place))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text_column])

    return rows.mapInArrow(decode, ", ".join([*names, f"`{text_column}` string"]))


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    for value in column:
        yield value.values.to_numpy().tolist() if value.is_valid else None
