"""Token counts by a compiled finite-state transducer.

A byte-level BPE vocabulary cuts a text into pieces by a rule on neighbouring characters, and merges bytes within each piece.
Both are finite-state, so no token is ever made here: a deterministic transducer reads bytes and adds up counts.

Compilation. Of two facts about merges by rank, (a) the tokens of a piece's prefix that end at a token border are the prefix's
own tokens, and (b) two tokens stand side by side exactly if merging their joined bytes gives those two again. So the last token
of each prefix is the one vocabulary entry that ends there and may follow the last token at its own start. A state holds, for
each place where a longer entry may have begun, the entry's trie node, the last token before it and how many tokens fewer there
were; a transition extends these places by one byte and is annotated with the change in the number of tokens, which is negative
where a longer entry replaces several. Transitions are compiled when a text first takes them and kept in two flat tables.

Running. The texts of a batch are one byte array with a reset at each piece's start, dealt into equal chunks which numpy runs in
step, each from an unknown state. A chunk's map from entry to exit state is constant once it holds a reset; the scan over chunks
hands each the exit state before it, then all unread chunk heads run in step again. Chunks without any reset (one piece longer than
a chunk) are maps that the scan evaluates in order. Texts of any length run in blocks whose exit state is the next block's entry.

Character classes are asked of the tokenizer's own splitter, and neighbours of its own merges, so both follow its Unicode tables.

Edge cases. Null and empty texts have no tokens. A special token's string in a text is one token, and what stands before and
behind it is tokenised apart. Repeated rows, null and repeated ids keep their rows; an empty table gives an empty result; only
``text`` is read and other columns stay, but for those that have the results' names: they are replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lakestrata.llm.common import arrow_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: States a worker keeps; beyond, it starts compiling afresh.
STATES = 200_000
#: Entries below a trie node that count as few.
FEW = 16
#: Code points of a block, and fewest and most bytes of a chunk.
BLOCK = 1 << 20
CHUNK = (64, 2048)

_UNKNOWN, _START = 0, 1
# character classes; the separator stands between texts
_SEP, _LETTER, _DIGIT, _SIGN, _SPACE, _BLANK, _UNSEEN = 0, 1, 2, 3, 4, 5, 255
# fixed: what the splitter takes off behind an apostrophe
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# characters before and behind a place that decide whether a piece starts there
_BEFORE, _BEHIND = 4, 2


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary's entries: itself if printable, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Transducer:
    """Counts of one vocabulary file of the tokenizers library; its tables grow with the transitions that texts take."""

    def __init__(self, vocabulary: str = VOCABULARY, states: int = STATES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        whole = Tokenizer.from_file(path)
        self._merge, self._split = whole.model.tokenize, whole.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in whole.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        with open(path, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self._children: list[dict[int, int]] = [{}]
        self._entry: list[str | None] = [None]
        for entry in entries:
            node = 0
            for c in entry:
                below = self._children[node]
                if (node := below.get(byte_of[c])) is None:
                    node = below[byte_of[c]] = len(self._children)
                    self._children.append({})
                    self._entry.append(None)
            self._entry[node] = entry
        self._below = self._descendants()
        self._class = np.full(0x110000, _UNSEEN, np.uint8)
        self._limit = states
        self._clear()

    # compilation ------------------------------------------------------------------------------------------------------

    def _descendants(self) -> list[frozenset[str] | None]:
        """Entries longer than each trie node's string, where they are few."""
        below: list[frozenset[str] | None] = [None] * len(self._entry)
        for node in range(len(self._entry) - 1, -1, -1):  # children have greater numbers
            found: set[str] | None = set()
            for child in self._children[node].values():
                if below[child] is None or found is None or len(found) + len(below[child]) >= FEW:
                    found = None
                    break
                found |= below[child]
                if self._entry[child] is not None:
                    found.add(self._entry[child])
            below[node] = None if found is None else frozenset(found)
        return below

    def _clear(self) -> None:
        self._states: list[tuple] = [(), ((0, None, 0),)]
        self._number = {s: i for i, s in enumerate(self._states)}
        self._beside: dict[tuple[str, str], bool] = {}
        self._fit: dict[tuple[int, str], frozenset[str]] = {}
        self._column = np.full(256, -1, np.int32)
        self._byte: list[int] = []
        self._next, self._gain = np.full((256, 64), -1, np.int32), np.zeros((256, 64), np.int8)
        self._next[_UNKNOWN] = _UNKNOWN

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """Table columns of bytes; a byte gets one when it first occurs."""
        for b in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self._column < 0)).tolist():
            if len(self._byte) == self._next.shape[1]:
                self._widen(0, len(self._byte))
            self._column[b] = len(self._byte)
            self._byte.append(b)
        return self._column[data]

    def _widen(self, rows: int, columns: int) -> None:
        self._next = np.pad(self._next, ((0, rows), (0, columns)), constant_values=-1)
        self._gain = np.pad(self._gain, ((0, rows), (0, columns)))
        self._next[_UNKNOWN] = _UNKNOWN

    def _may_follow(self, a: str, b: str) -> bool:
        known = self._beside.get((a, b))
        if known is None:
            known = self._beside[(a, b)] = self._stay(a, b)
        return known

    def _stay(self, a: str, b: str) -> bool:
        return [t.value for t in self._merge(a + b)] == [a, b]

    def _state(self, places: tuple) -> int:
        number = self._number.get(places)
        if number is None:
            number = self._number[places] = len(self._states)
            self._states.append(places)
            if number == len(self._next):
                self._widen(number, 0)
        return number

    def _compile(self, state: int, column: int) -> None:
        """Fill in one transition."""
        byte, found, longer = self._byte[column], None, []
        for node, last, fewer in self._states[state]:
            node = self._children[node].get(byte)
            if node is None:
                continue
            entry, below = self._entry[node], self._below[node]
            if entry is not None and found is None and self._fits(last, entry):
                found = (entry, fewer + 1)
            if below is None:
                longer.append((node, last, fewer))
            elif below:
                # few entries are left: what matters of the last token is which of them may follow it
                fit = self._fitting(node, last, below)
                if fit:
                    longer.append((node, fit, fewer))
        entry, gain = found
        places = ((0, entry, 0), *((node, last, fewer - gain) for node, last, fewer in longer))
        target = self._state(places)
        self._next[state, column], self._gain[state, column] = target, gain

    def _fits(self, last: str | frozenset[str] | None, entry: str) -> bool:
        if isinstance(last, frozenset):
            return entry in last
        return last is None or self._may_follow(last, entry)

    def _fitting(self, node: int, last: str | frozenset[str] | None, below: frozenset[str]) -> frozenset[str]:
        if isinstance(last, frozenset):
            return last & below
        if last is None:
            return below
        found = self._fit.get((node, last))
        if found is None:
            found = self._fit[(node, last)] = frozenset(e for e in below if self._stay(last, e))
        return found

    # pieces -----------------------------------------------------------------------------------------------------------

    def _classes(self, points: np.ndarray) -> np.ndarray:
        found = self._class[points]
        if (found == _UNSEEN).any():
            new = np.unique(points[found == _UNSEEN])
            self._class[new] = _BLANK
            for kind, mate in ((_LETTER, "a"), (_DIGIT, "1"), (_SIGN, "!")):
                ends = {b for _, (_, b) in self._split("".join(f"{mate}{chr(p)}" for p in new.tolist()))}
                # joined to its mate unless a piece ends between the two
                self._class[[p for i, p in enumerate(new.tolist()) if 2 * i + 1 not in ends]] = kind
            self._class[32] = _SPACE
            found = self._class[points]
        return found

    def starts(self, points: np.ndarray, seps: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each code point; at the places ``seps`` stand separators."""
        kind = self._classes(points)
        kind[seps] = _SEP
        before = np.concatenate([[_SEP], kind[:-1]]).astype(np.uint8)
        behind = np.concatenate([kind[1:], [_SEP]]).astype(np.uint8)
        blank = kind >= _SPACE
        start = np.where(blank, (before < _SPACE) | ((behind >= _LETTER) & (behind <= _SIGN)), (before != kind) & (before != _SPACE))
        mark = np.flatnonzero((points == 39) & start & (kind == _SIGN))
        for ending in _ENDINGS if len(mark) else ():
            at = mark[mark + len(ending) < len(points)]
            for i, c in enumerate(ending, 1):
                at = at[(points[at + i] == ord(c)) & (kind[at + i] != _SEP)]
            start[at + 1] = False
            after = at + len(ending) + 1
            start[after[after < len(points)]] = True
        return start

    # running ----------------------------------------------------------------------------------------------------------

    def _advance(self, states: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and gains of chunks that each read one byte."""
        at = states * self._next.shape[1] + columns
        after = self._next.ravel().take(at)
        if len(after) and after.min() < 0:
            for state, column in set(zip(states[after < 0].tolist(), columns[after < 0].tolist())):
                self._compile(state, column)
            at = states * self._next.shape[1] + columns
            after = self._next.ravel().take(at)
        return after, self._gain.ravel().take(at)

    def gains(self, data: np.ndarray, resets: np.ndarray, entry: int) -> tuple[np.ndarray, int]:
        """Change in the number of tokens at each byte, and the exit state; ``entry`` is the state before the first byte."""
        n = len(data)
        width = int(np.clip(n // 4096, *CHUNK))
        lanes = -(-n // width)
        columns = np.zeros(lanes * width, np.int64)
        columns[:n] = self._columns(data)
        reset = np.ones(lanes * width, bool)
        reset[:n] = resets
        columns, reset = np.ascontiguousarray(columns.reshape(lanes, width).T), np.ascontiguousarray(reset.reshape(lanes, width).T)
        gains = np.zeros((width, lanes), np.int8)
        states = np.full(lanes, _UNKNOWN, np.int32)
        states[0] = entry
        tail = width - (lanes * width - n)  # bytes of the last chunk
        out = entry
        for j in range(width):
            states[reset[j]] = _START
            states, gains[j] = self._advance(states, columns[j])
            if j == tail - 1:
                out = int(states[-1])
        # the scan: a chunk's head is read once the exit state before it is known
        heads = np.where(reset.any(axis=0), reset.argmax(axis=0), width)
        heads[0] = 0
        known = (heads < width) | (np.arange(lanes) == 0)
        known[0] = True
        waiting = np.flatnonzero(heads > 0)
        while len(waiting):
            ready = waiting[known[waiting - 1]]
            waiting = waiting[~known[waiting - 1]]
            ready = ready[np.argsort(-heads[ready], kind="stable")]
            run, length = states[ready - 1].copy(), heads[ready]
            for j in range(int(length[0])):
                active = int(np.searchsorted(-length, -j, side="left"))
                run[:active], gains[j, ready[:active]] = self._advance(run[:active], columns[j, ready[:active]])
                if j == tail - 1 and heads[-1] >= tail and ready[:active].max() == lanes - 1:
                    out = int(run[np.flatnonzero(ready == lanes - 1)[0]])
            whole = heads[ready] == width
            states[ready[whole]] = run[whole]
            known[ready[whole]] = True
        return gains.T.ravel()[:n], out

    def _block(self, text: str, seps: np.ndarray, entry: int, before: int = 0, behind: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Gains of the code points of ``text`` but for the first ``before`` and the last ``behind``, with each one's byte end."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        start = self.starts(points, seps)
        keep = np.ones(len(points), bool)
        keep[seps] = False
        keep[:before] = False
        keep[len(points) - behind :] = False
        points, start = points[keep], start[keep]
        ends = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
        data = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        resets = np.zeros(len(data), bool)
        resets[np.concatenate([[0], ends[:-1]])[start]] = True
        gains, out = self.gains(data, resets, entry)
        return gains, ends, out

    def _long(self, text: str) -> int:
        """Tokens of one text, block by block."""
        total, state = 0, self._states[_START]
        for a in range(0, len(text), BLOCK):
            b = min(a + BLOCK, len(text))
            lead, trail = min(a, _BEFORE), min(len(text) - b, _BEHIND)
            if len(self._states) > self._limit:
                self._clear()
            gains, _, out = self._block(text[a - lead : b + trail], np.zeros(0, np.int64), self._state(state), lead, trail)
            total, state = total + int(gains.sum(dtype=np.int64)), self._states[out]
        return total

    def _short(self, texts: list[str]) -> np.ndarray:
        """Tokens of several texts that together make one block."""
        if len(self._states) > self._limit:
            self._clear()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stops = np.cumsum(sizes)
        gains, ends, _ = self._block("\0".join(texts), (stops + np.arange(len(texts)))[:-1], _START)
        sums = np.concatenate([[0], np.cumsum(gains, dtype=np.int64)])
        return np.diff(sums[np.concatenate([[0], ends[stops - 1]])])

    def counts(self, texts: Iterable[str | None]) -> np.ndarray:
        """Tokens of each text."""
        owners, parts, totals = [], [], []
        for i, text in enumerate(texts):
            totals.append(0)
            pieces = [text or ""]
            if self._special is not None and text and self._special.search(text):
                totals[i] = sum(1 for _ in self._special.finditer(text))
                pieces = self._special.split(text)
            for piece in filter(None, pieces):
                if len(piece) > BLOCK:
                    totals[i] += self._long(piece)
                else:
                    owners.append(i)
                    parts.append(piece)
        totals, a = np.array(totals, np.int64), 0
        while a < len(parts):
            b, held = a, 0
            while b < len(parts) and (b == a or held + len(parts[b]) <= BLOCK):
                held, b = held + len(parts[b]), b + 1
            np.add.at(totals, owners[a:b], self._short(parts[a:b]))
            a = b
        return totals


_MACHINES: dict[str, Transducer] = {}


def transducer(vocabulary: str) -> Transducer:
    """This worker's transducer of a vocabulary."""
    if vocabulary not in _MACHINES:
        _MACHINES[vocabulary] = Transducer(vocabulary)
    return _MACHINES[vocabulary]


def _counter(vocabulary: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = transducer(vocabulary)
        for texts in batches:
            yield pd.Series(machine.counts(texts.tolist()))

    return F.pandas_udf(run, LongType())


def counted(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit. ``vocabulary`` is a byte-level BPE file of the tokenizers library."""
    arrow_batches(docs.sparkSession)
    names = ("n_bytes", "n_tokens", "over_limit")
    tokens = _counter(vocabulary)(F.col("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    kept = docs.select(*[docs[f"`{c.replace('`', '``')}`"] for c in docs.columns if c.lower() not in names])
    return kept.withColumns({"n_bytes": size, "n_tokens": tokens}).withColumn("over_limit", F.col("n_tokens") > limit)
