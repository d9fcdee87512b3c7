"""BPE encoding and decoding with a contiguous rank array.

A word (pre-token) is held as the list of its part boundaries and, beside it,
the merge ranks of adjacent parts. Until no adjacent pair can merge, the
lowest rank is looked up by one scan (leftmost on ties), its inner boundary is
deleted and the ranks of the two neighbours are looked up again. For short
words this beats any heap; words of more than ``SHORT`` bytes, where the scan
would turn quadratic, use a heap over the same boundaries with the same order
of merges.

The vocabulary is a ``tokenizers`` JSON file (byte-level BPE) whose path is a
parameter; it is read once in each Python worker's process. Text is cut before
each space that a non-space follows, which is always a pre-token boundary, and
the ids of each such chunk are memoised (the memo has a fixed size, so memory
is bounded; results do not depend on it). The new words of a batch are encoded
together as rows of a matrix. A text's ids are one array: its bytes and the
decimal ids that are hashed are gathered from one string of all tokens' bytes
and one of all ids' digits.

Cases: a null text counts as empty and gives no ids; added tokens in a text
become their single id, as the library does by default; repeated rows are each
encoded; an empty table gives an empty result; columns other than the two
named are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from itertools import chain
from sys import getsizeof

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import held, id_and_text, map_rows

#: Fixed value: the byte-level pre-tokenisation pattern of the vocabulary files.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words of more bytes than this use the heap; rows of one matrix.
SHORT = 96
CLASSES = (4, 8, 12, 16, 24, 32, 48, 64, 96)
ROWS = 16_384
#: Chunks of more characters are not remembered; bytes that a half of the memo may hold, and that an entry costs besides
#: its chunk and its ids (a bytes object 33 and the padding of both, its place in the dict up to 44).
LONGEST, HALF_BYTES, ENTRY_BYTES = 64, 48_000_000, 96
NO_RANK = 1 << 30


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: visible Latin-1 characters
    stand for themselves, the other bytes take code points from 256 on."""
    visible = [b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)]
    rest = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """One string for each number, all in one array, to be joined by number."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.whole = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, which: np.ndarray, block: int = 1 << 18) -> bytes:
        return b"".join(self._joined(which[i:i + block]) for i in range(0, len(which), block))

    def _joined(self, which: np.ndarray) -> bytes:
        size = self.size[which]
        end = np.cumsum(size)
        at = np.arange(end[-1])
        at += np.repeat(self.start[which] - end + size, size)
        return self.whole[at].tobytes()


class RankArrayBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: only byte-level BPE without normaliser or prefix space is supported")
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: unsupported BPE options")
        added = spec.get("added_tokens") or []
        if any(a.get(k) for a in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that strip or need word limits are not supported")
        alphabet = byte_alphabet()
        raw = lambda token: bytes(map(alphabet.__getitem__, token))
        self.id_of = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(merges)}
        keys = np.array([self.id_of[a] << 32 | self.id_of[b] for a, b in self.rank], np.int64)
        self.pair_ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.pair_keys = keys[self.pair_ranks]
        self.merged = np.array([self.id_of[a + b] for a, b in self.rank], np.int32)
        self.byte_id = np.array([self.id_of[bytes((b,))] for b in range(256)], np.int32)
        self.byte_pair_rank = np.array([self.rank.get((bytes((a,)), bytes((b,))), NO_RANK) for a in range(256) for b in range(256)], np.int32)
        self.added = {a["content"]: a["id"] for a in added if a["content"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        numbers = range(max(self.bytes_of) + 1)
        self.tokens, self.digits = Pieces([self.bytes_of.get(i, b"") for i in numbers]), Pieces([b"%d," % i for i in numbers])
        self.kind = np.dtype(np.uint16 if len(numbers) <= 1 << 16 else np.int32)  # of ids in the memo
        self.cut_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pretokens = regex.compile(PRETOKEN).findall
        self.chunks = re.compile(r" (?=\S)").split
        self.starts, self.loose = re.compile(r" \S").match, re.compile(r" (?!\S)").search
        self.added_ids = {t: self.packed([i]) for t, i in self.added.items()}
        self.memo: dict[str, bytes] = dict(self.added_ids)
        self.old: dict[str, bytes] = {}
        self.size = 0  # bytes of the memo's young half
        self.passing: list[str] = []  # long chunks, in the memo for one batch

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        return [tuple(np.frombuffer(ids, self.kind).tolist()) for ids in self.encode_packed(words)]

    def encode_packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, packed: short ones by length class in one matrix each."""
        out = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            w, bounds = words[i], self._heap(words[i])
            out[i] = self.packed([self.id_of[w[a:b]] for a, b in zip(bounds, bounds[1:])])
        for low, width in zip((0, *CLASSES), CLASSES):
            members = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            for at in range(0, len(members), ROWS):
                some = members[at:at + ROWS]
                for i, ids in zip(some, self._scan([words[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def _scan(self, words: list[bytes], width: int) -> list[bytes]:
        """The rank array of many words at once, one row each: ``parts[r]`` holds
        the ids of the parts between row r's boundaries, ``ranks[r]`` the ranks
        of adjacent parts. A step takes each row's lowest rank, deletes the
        boundary there and looks the neighbours' ranks up again; rows without
        a rank are done. Every step shortens all remaining rows by one part."""
        done, size = [b""] * len(words), self.kind.itemsize
        row, left = np.arange(len(words)), np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        parts = self.byte_id[raw]
        ranks = self.byte_pair_rank[raw[:, :-1].astype(np.int64) * 256 + raw[:, 1:]] if width > 1 else np.full((len(words), 0), NO_RANK, np.int32)
        ranks[np.arange(1, width)[None, :] >= left[:, None]] = NO_RANK
        while True:
            best = ranks.min(axis=1) if ranks.shape[1] else np.full(len(row), NO_RANK)
            ended = best == NO_RANK
            ids, step = parts[ended].astype(self.kind).tobytes(), parts.shape[1] * size
            for at, (r, n) in enumerate(zip(row[ended].tolist(), (left[ended] * size).tolist())):
                done[r] = ids[at * step:at * step + n]
            if ended.all():
                return done
            going = ~ended
            row, left, parts, ranks, best = row[going], left[going] - 1, parts[going], ranks[going], best[going]
            i, each = ranks.argmin(axis=1), np.arange(len(row))
            column = np.arange(parts.shape[1] - 1)[None, :]
            parts = np.where(column <= i[:, None], parts[:, :-1], parts[:, 1:])
            ranks = np.where(column[:, :-1] < i[:, None], ranks[:, :-1], ranks[:, 1:])
            new = self.merged[best]
            parts[each, i] = new
            after = i + 1 < left
            ranks[each[after], i[after]] = self._pairs(new[after], parts[each[after], i[after] + 1])
            before = i > 0
            ranks[each[before], i[before] - 1] = self._pairs(parts[each[before], i[before] - 1], new[before])

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK).astype(np.int32)

    def _heap(self, word: bytes) -> list[int]:
        n, rank = len(word), self.rank
        after, before = list(range(1, n + 2)), list(range(-1, n))  # next and previous boundary
        alive = [True] * (n + 1)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get((word[i:i + 1], word[i + 1:i + 2]))) is not None]
        heapq.heapify(heap)

        def push(a: int) -> None:
            m = after[a]
            if m < n and (r := rank.get((word[a:m], word[m:after[m]]))) is not None:
                heapq.heappush(heap, (r, a, after[m]))

        while heap:
            r, a, end = heapq.heappop(heap)
            m = after[a] if alive[a] else n
            if m >= n or after[m] != end or rank.get((word[a:m], word[m:end])) != r:
                continue
            alive[m] = False
            after[a], before[end] = end, a
            push(a)
            if a:
                push(before[a])
        return [i for i in range(n + 1) if alive[i]]

    def learn(self, keys: set[str]) -> None:
        """Put the ids of these chunks into the memo, packed.
        When the memo's young half is full, by bytes, it becomes the old one; what is
        still used is taken over. Long chunks (a text without spaces is one) leave
        after the batch, so the memo's bytes are bounded whatever the texts."""
        if self.size >= HALF_BYTES:
            self.old, self.memo, self.size = self.memo, dict(self.added_ids), 0
        missing = []
        for k in keys:
            if k not in self.memo:
                if (ids := self.old.get(k)) is None:
                    missing.append(k)
                else:
                    self._keep(k, ids)
        cut = self._cut(missing)
        # a word is a chunk as well, and those found in the memo need not be encoded again
        words, known = {k for k in missing if k not in cut}, {}
        for w in set(chain.from_iterable(cut.values())):
            if (ids := self.memo.get(w) or self.old.get(w)) is None:
                words.add(w)
            else:
                known[w] = ids
        new = list(words)
        known |= zip(new, self.encode_packed([w.encode() for w in new]), strict=True)
        for k in missing:
            self._keep(k, known[k] if k not in cut else b"".join(map(known.__getitem__, cut[k])))

    def _cut(self, chunks: list[str]) -> dict[str, list[str]]:
        """The words of those chunks that have several. ASCII letters, with or without the space
        before them, are one word; chunks that begin with a space and a non-space are
        cut as one text, as such a space is a boundary wherever it stands."""
        rest = [k for k in chunks if not (k.isascii() and (k.isalpha() or k[1:].isalpha() and k[0] == " "))]
        cut = {k: self.pretokens(k) for k in rest if not self.starts(k)}
        rest = [k for k in rest if k not in cut]
        words = iter(self.pretokens("".join(rest)))
        for k in rest:
            w = next(words)
            if len(w) < len(k):
                cut[k], n = (parts := [w]), len(w)
                while n < len(k):
                    parts.append(w := next(words))
                    n += len(w)
        return {k: parts for k, parts in cut.items() if len(parts) > 1}

    def _keep(self, k: str, ids: bytes) -> None:
        self.memo[k] = ids
        if len(k) > LONGEST:
            self.passing.append(k)
        else:
            self.size += ENTRY_BYTES + getsizeof(k) + len(ids)

    def _keys(self, text: str) -> list[str]:
        parts = [text] if self.cut_added is None else self.cut_added.split(text)
        keys: list[str] = []
        for part in parts:
            if part in self.added:
                keys.append(part)
            elif part:
                first, *rest = self.chunks(part) if self.loose(part) else part.split(" ")
                keys.append(first)
                keys += [" " + c for c in rest]
        return keys

    def encode_arrays(self, texts: list[str]) -> list[np.ndarray]:
        keys = [self._keys(t) for t in texts]
        self.learn(set().union(*keys))
        get = self.memo.__getitem__
        out = [np.frombuffer(b"".join(map(get, ks)), self.kind) for ks in keys]
        for k in self.passing:
            del self.memo[k]
        self.passing.clear()
        return out

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts)]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        return self.tokens.joined(np.asarray(ids, np.int64)).decode("utf-8", errors="replace")

    def digest(self, ids: list[int] | np.ndarray) -> str:
        return hashlib.sha256(self.digits.joined(np.asarray(ids, np.int64))[:-1]).hexdigest()


def tokenizer(path: str) -> RankArrayBPE:
    return held(("bpe", path), lambda: RankArrayBPE(path))


def encode_decode(docs: DataFrame, vocabulary: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) per row.

    ``with_ids`` adds the token ids and the decoded text themselves."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(cols: dict) -> dict:
        bpe = tokenizer(vocabulary)
        out: dict[str, list] = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
        for ids in bpe.encode_arrays(cols["text"]):
            decoded = bpe.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(bpe.digest(ids))
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_ids:
                out["ids"].append(ids.tolist())
                out["decoded"].append(decoded)
        return out

    return map_rows(id_and_text(docs, id_col, text_col), run, schema, keeps=True)
