"""Packing documents in their order by dynamic programming over document and sentence boundaries.

The documents of a scan task, one after another, are one line of tokens. It is
cut into windows of at most ``size`` tokens; cuts lie at ends of documents
(free), ends of sentences (a penalty) or, inside a stretch of more than
``size`` tokens without either, at evenly spaced places (a higher penalty). A
window is padded to ``size`` unless its length is a power of two. The cuts of
least padding plus penalties come from

    cost(j) = penalty(j) + min over i of cost(i) + padding(place(j) - place(i))

where padded windows take the least of cost(i) + place(i) over the boundaries
up to ``size`` tokens back, the head of a monotone queue, and windows of a power
of two are looked up by their place. Each boundary enters and leaves the queue
once, so the work is linear.

Nothing is shuffled: the order that is kept is the one in which the rows of a
task stand, and every task closes its last window.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import narrow, sliced
from .tokens import byte_alphabet

# Fixed value: how this tokenizer cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# What a byte is to the ends of sentences.
STOP, CLOSER, SPACE, BREAK = 1, 2, 4, 8
KINDS = np.zeros(256, np.uint8)
KINDS[list(b".!?")] = STOP
KINDS[list(b"\"')]")] = CLOSER
KINDS[list(b" \t\v\f\r")] = SPACE
KINDS[list(b"\n")] = SPACE | BREAK


def sentence_ends(data: bytes) -> np.ndarray:
    """The places in UTF-8 text after which a sentence has ended: after a stop and up to two closing quotes or
    brackets that white space follows, and after a line break."""
    kinds = KINDS[np.frombuffer(data + b"000", np.uint8)]  # three more bytes of no kind
    after = np.flatnonzero(kinds & STOP) + 1
    for _ in range(2):
        after += (kinds[after] & CLOSER) > 0
    return np.concatenate([after[(kinds[after] & SPACE) > 0], np.flatnonzero(kinds & BREAK) + 1])


class SentenceEncoder:
    """Ids of texts as the tokenizers library gives them, and after which of them a sentence ends.

    The ids of a byte-level BPE file follow the order of its merges, so they
    are the ranks that tiktoken merges by, which takes half the time and keeps
    nothing. Texts that hold a special string go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        own = byte_alphabet()
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {bytes(own[c] for c in shown): i for shown, i in vocabulary.items() if shown not in self.special}
        self.ranks = tiktoken.Encoding(path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max([*ranks.values(), *self.library.get_added_tokens_decoder()]) + 1, np.int64)
        for data, i in ranks.items():
            self.sizes[i] = len(data)
        for i, t in self.library.get_added_tokens_decoder().items():
            self.sizes[i] = len(t.content.encode())

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Little-endian unsigned 32-bit ids, and the numbers of ids before which a sentence has ended."""
        if not text:
            return b"", np.empty(0, np.int64)
        if any(s in text for s in self.special):
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        else:
            ids = np.array(self.ranks.encode_ordinary(text), "<u4")
        places = sentence_ends(text.encode("utf-8", "surrogatepass"))
        ends = np.unique(np.searchsorted(np.cumsum(self.sizes[ids]), places)) + 1
        return ids.tobytes(), ends[ends < len(ids)]


_ENCODERS: dict[str, SentenceEncoder] = {}


def encoder(path: str) -> SentenceEncoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SentenceEncoder(path)
    return _ENCODERS[path]


def with_forced(places: list[int], penalties: list[float], size: int, hard: float) -> tuple[list[int], list[float]]:
    """Boundaries with further ones, ``size`` / 8 apart, where two neighbours are more than ``size`` apart."""
    step = max(1, size // 8)
    out_places, out_penalties, last = [0], [0.0], 0
    for place, penalty in zip(places, penalties):
        if place - last > size:
            more = range(last + step, place, step)
            out_places += more
            out_penalties += [hard] * len(more)
        out_places.append(place)
        out_penalties.append(penalty)
        last = place
    return out_places, out_penalties


def cheapest_cuts(places: list[int], penalties: list[float], size: int, window_cost: float) -> list[int]:
    """The places of the cuts of least cost, the last place included.

    ``places`` rise from 0, no two neighbours more than ``size`` apart; a cut at
    a place costs its penalty, every window ``window_cost`` and its padding up
    to ``size``, which a length that is a power of two doesn't need. Of cuts of
    equal cost, padded windows and longer powers of two win.
    """
    n = len(places)
    index = [-1] * (places[-1] + 1)
    for i, p in enumerate(places):
        index[p] = i
    powers = [1 << k for k in range(size.bit_length() - 1, -1, -1)]
    cost, came = [0.0] * n, [0] * n
    queue: deque[int] = deque([0])  # their cost + place rises
    for j in range(1, n):
        place = places[j]
        while place - places[queue[0]] > size:
            queue.popleft()
        came[j] = head = queue[0]
        best = cost[head] + size - place + places[head]
        for p in powers if place >= size else [p for p in powers if p <= place]:
            i = index[place - p]
            if i >= 0 and cost[i] < best:
                best, came[j] = cost[i], i
        cost[j] = best = best + penalties[j] + window_cost
        best += place
        while queue and cost[queue[-1]] + places[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(places[j])
        j = came[j]
    return out[::-1]


def padding(length: int, size: int) -> int:
    return 0 if length & (length - 1) == 0 else size - length


class Line:
    """Documents laid one after another until there are enough tokens to cut them into windows."""

    def __init__(self, size: int, sentence_penalty: float, hard_penalty: float, window_cost: float, first: int):
        self.size, self.sentence, self.hard, self.window = size, sentence_penalty, hard_penalty, window_cost
        self.sequence = first
        self.start()

    def start(self) -> None:
        self.docs: list[tuple[int | None, int, int, bytes]] = []  # id, place, tokens, ids
        self.places: list[int] = []
        self.penalties: list[float] = []
        self.tokens = 0

    def add(self, key: int | None, body: bytes, sentences: np.ndarray) -> None:
        n = len(body) // 4
        self.docs.append((key, self.tokens, n, body))
        self.places += (sentences + self.tokens).tolist()
        self.penalties += [self.sentence] * len(sentences)
        self.tokens += n
        self.places.append(self.tokens)
        self.penalties.append(0.0)

    def rows(self) -> dict[str, list]:
        """The pieces of all documents so far, then a new line."""
        cuts = cheapest_cuts(*with_forced(self.places, self.penalties, self.size, self.hard), self.size, self.window)
        out: dict[str, list] = {c: [] for c in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        k = begin = 0
        for key, place, n, body in self.docs:
            at = place
            while at < place + n:
                end = min(cuts[k], place + n)
                part = body[4 * (at - place) : 4 * (end - place)]
                row = (key, at - place, end - at, zlib.crc32(part), n, self.sequence, at - begin)
                for column, value in zip(out.values(), row):
                    column.append(value)
                at = end
                if at == cuts[k]:
                    begin, k, self.sequence = at, k + 1, self.sequence + 1
        self.start()
        return out


def pack_in_order(
    df: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    sentence_penalty: float = 16.0,
    hard_penalty: float = 256.0,
    window_cost: float = 1.0,
    line_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all texts, in the order in which they stand, into sequences of at most ``size`` tokens.

    A text is its ids followed by ``end_id``; null is taken as empty, so every
    row gives at least one token. Cuts lie at ends of documents for nothing, at
    ends of sentences (see `sentence_ends`) for
    ``sentence_penalty`` tokens, and for ``hard_penalty`` elsewhere, there only
    within stretches of more than ``size`` tokens; ``window_cost`` tells what a
    sequence costs beside its padding. Of all such cuts the cheapest are taken.
    A sequence is padded to ``size`` unless its length is a power of two.

    Returns a row for each piece: ``id_col``, start (ids of its text before it),
    length, ids_crc32, doc_tokens (``end_id`` included), sequence_id and offset
    (its place there; pieces lie side by side from 0). Repeated rows are packed
    each; ids may be null or repeat; an empty table gives no rows.

    One pass without a shuffle or key, so no id, source or length can be hot. A
    task holds the documents of ``line_tokens`` tokens at once, or one longer
    document; each such line is cut by itself, and its last window may need
    padding. Numbers of sequences begin with the number of the task, so a task
    that is run again gives the same rows as long as it reads the same ones.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end_id], "<u4").tobytes()
        encode = encoder(tokenizer).encode
        line = Line(size, sentence_penalty, hard_penalty, window_cost, TaskContext.get().partitionId() << 40)
        for ids, texts in sliced(batches):
            for key, text in zip(ids, texts):
                body, sentences = encode(text or "")
                line.add(key, body + tail, sentences)
                if line.tokens >= line_tokens:
                    yield pa.RecordBatch.from_pydict(line.rows(), schema=types)
        if line.docs:
            yield pa.RecordBatch.from_pydict(line.rows(), schema=types)

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    types = pa.schema([("id" if k == 0 else c, pa.int64()) for k, c in enumerate(names)])
    out = narrow(df, id_col, text_col).mapInArrow(run, ", ".join(f"{c} long" for c in types.names))
    return out.withColumnRenamed("id", id_col)
