"""Token counts of every prefix of a text (byte-level BPE), by prefix dynamic programming.

The tokenizer cuts a text into pieces and merges bytes inside a piece. Within a
piece the tokens of a prefix are found from those of shorter prefixes: the last
token of the prefix ending at byte ``i`` is the one vocabulary entry ``t``
ending there that can follow the last token of the prefix at ``i - len(t)``
(two tokens can follow each other if merging their joined bytes gives the same
two tokens again), and the count is one more than there. Across pieces counts
add up, so one pass stores the exact count of every prefix, and questions about
budgets or truncation are look-ups: nothing is encoded again.

A prefix that ends inside a run of white space, a contraction or a special
string is cut into pieces in another way than the whole text is; those places
are corrected (`PrefixCounter.prefixes`).
"""

from __future__ import annotations

import json
import re
from struct import pack

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, narrow

# The characters of Latin-1 that are letters, numbers and white space in Unicode,
# the white space beyond Latin-1, and the contractions that the pattern of this tokenizer names.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
WIDE_SPACES = SPACES + "  -     　"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

HEAD = 6  # bytes whose tokens are remembered for all pieces that begin with them

PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
RUNS = re.compile(f"[{WIDE_SPACES}]{{2,}}(?=[^{WIDE_SPACES}])")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file -> the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceCounts(dict):
    """piece -> counts of its prefixes, for each code point, as packed 32-bit numbers; remembers short pieces."""

    def __init__(self, ids: dict[bytes, int], parts: list[tuple[int, int]], joined: dict[tuple[int, int], int], most: int):
        super().__init__()
        self.parts, self.joined, self.most = parts, joined, most
        # a tree of the tokens' bytes: node << 8 | byte -> node, and the token that ends at a node
        self.step: dict[int, int] = {}
        self.token = [-1]
        for data, t in ids.items():
            node = 0
            for byte in data:
                nxt = self.step.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.step[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = t
        self.follows: dict[int, bool] = {}
        self.heads: dict[bytes, tuple[list[int], list[int]]] = {}

    def can_follow(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the same two tokens again.

        It doesn't if a merge across the border comes before one that built
        either side up to the border. Ids follow the order of the merges, so
        both sides are taken apart along the border, the later merge first; a
        pair that meets on the way and merges earlier than what was just taken
        apart breaks the two tokens up.
        """
        parts, joined = self.parts, self.joined
        before = len(parts)
        while True:
            if joined.get((left, right), before) < before:
                return False
            lower, upper = parts[left][1], parts[right][0]
            whole_left, whole_right = lower == left, upper == right  # single bytes
            if whole_left and whole_right:
                return True
            if whole_right or (left > right and not whole_left):
                before, left = left, lower
            else:
                before, right = right + 1, upper

    def tokens(self, data: bytes, last: list[int], count: list[int], known: int) -> None:
        """Find the last token and the count of each prefix; those of the first ``known`` bytes are there."""
        step, token, seen = self.step.get, self.token, self.follows
        n = len(data)
        if len(seen) > 4 * self.most:
            seen.clear()
        for j in range(n):  # the tokens that can begin where the prefix of j bytes ends
            node, left, total = 0, last[j], count[j] + 1
            for i in range(j + 1, n + 1):
                node = step(node << 8 | data[i - 1])
                if node is None:
                    break
                t = token[node]
                if i > known and t >= 0 and last[i] < 0:
                    follows = j == 0 or seen.get(left << 20 | t)
                    if follows is None:
                        follows = seen[left << 20 | t] = self.can_follow(left, t)
                    if follows:
                        last[i], count[i] = t, total

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        n = len(data)
        last, count, known = [-1] * (n + 1), [0] * (n + 1), 0
        if n > HEAD:  # many pieces begin alike
            head = data[:HEAD]
            if head not in self.heads:
                if len(self.heads) >= self.most:
                    self.heads.clear()
                self.heads[head] = [-1] * (HEAD + 1), [0] * (HEAD + 1)
                self.tokens(head, *self.heads[head], 0)
            known = HEAD
            last[: HEAD + 1], count[: HEAD + 1] = self.heads[head]
        self.tokens(data, last, count, known)
        if n != len(piece):
            count = [0] + [count[i] for i in range(1, n + 1) if i == n or data[i] & 0xC0 != 0x80]
        out = pack(f"={len(count) - 1}I", *count[1:])
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = out
        return out


class PrefixCounter:
    """Token counts of the prefixes of texts, for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # cuts texts beyond Latin-1 into pieces
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        own = byte_alphabet()
        raw = lambda s: bytes(own[c] for c in s)
        # numbers in the order of the merges: the single bytes, then what each merge makes
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = {bytes([b]): b for b in range(256)}
        parts = [(b, b) for b in range(256)]
        joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair = ids[raw(a)], ids[raw(b)]
            joined[pair] = ids[raw(a) + raw(b)] = len(parts)
            parts.append(pair)
        self.pieces = PieceCounts(ids, parts, joined, most)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return PIECES.findall(text)

    def plain(self, text: str) -> np.ndarray:
        """prefixes() of a text without special strings."""
        pieces = self.cut(text)
        own = list(map(self.pieces.__getitem__, pieces))
        counts = np.frombuffer(b"".join(own), np.uint32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        totals = counts[ends - 1]
        out = np.zeros(len(counts) + 1, np.int32)
        np.add(counts, np.repeat((np.cumsum(totals, dtype=np.int32) - totals).astype(np.int32), lengths), out=out[1:], casting="unsafe")
        for p, e in zip(pieces, ends) if any(c in text for c in LONG_CONTRACTIONS) else ():
            if p in LONG_CONTRACTIONS:  # cut after two characters: an apostrophe and a letter
                out[e - 1] = out[e - 3] + 2
        for m in RUNS.finditer(text):  # cut after a run: the run is one piece
            out[m.end()] = out[m.start()] + np.frombuffer(self.pieces[m.group()], np.uint32)[-1]
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """n + 1 numbers: the token count of text[:i] for i from 0 to the text's length n.

        Special strings count as the library takes them by default: one token each.
        """
        if not text:
            return np.zeros(1, np.int32)
        found = list(self.specials.finditer(text)) if self.specials and any(s in text for s in self.special) else []
        if not found:
            return self.plain(text)
        out, start = [np.zeros(1, np.int32)], 0
        for m in found:
            before = text[start : m.start()]
            part = self.plain(before) if before else np.zeros(1, np.int32)
            base = out[-1][-1]
            # a prefix that ends inside the special string holds its beginning as ordinary text
            inside = [self.plain(before + m.group()[:k])[-1] for k in range(1, len(m.group()))]
            out += [base + part[1:], base + np.array([*inside, part[-1] + 1], np.int32)]
            out = [np.concatenate(out)]
            start = m.end()
        rest = text[start:]
        return np.concatenate([out[0], out[0][-1] + self.plain(rest)[1:]]) if rest else out[0]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def longest_prefix(prefixes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens (counts need not rise with every character)."""
    return int(np.flatnonzero(prefixes <= budget)[-1])


def token_prefixes(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col`` and ``prefix_tokens``, the token count of every prefix.

    ``prefix_tokens[i]`` belongs to the first ``i`` code points, so the array
    has one entry more than the text has code points. Null and empty texts have
    the array [0]. Repeated rows give repeated rows; an empty table none.
    """

    def each(ids: list, texts: list) -> dict:
        c = counter(tokenizer)
        return {id_col: ids, "prefix_tokens": [c.prefixes(t or "").tolist() for t in texts]}

    return map_texts(narrow(df, id_col, text_col), f"`{id_col}` long, prefix_tokens array<int>", each)


def token_counts(
    df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every text and how much of it a budget of ``limit`` tokens holds.

    One row per row, read off the counts of all prefixes: ``n_bytes`` (UTF-8),
    ``n_tokens``, ``over_limit`` and ``fit_chars``, the code points of the
    longest prefix of at most ``limit`` tokens. Null is taken as empty: 0 bytes,
    0 tokens. Repeated rows give repeated rows; an empty table gives none. The
    work is one pass without a shuffle; memory is bounded by a few MB of text
    beside the longest single text.
    """

    def each(ids: list, texts: list) -> dict:
        c = counter(tokenizer)
        sizes, counts, fits = [], [], []
        for t in texts:
            p = c.prefixes(t or "")
            sizes.append(len(t.encode("utf-8", "surrogatepass")) if t else 0)
            counts.append(int(p[-1]))
            fits.append(longest_prefix(p, limit) if p[-1] > limit else len(p) - 1)
        return {
            id_col: ids,
            "n_bytes": sizes,
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
            "fit_chars": fits,
        }

    schema = f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return map_texts(narrow(df, id_col, text_col), schema, each)
