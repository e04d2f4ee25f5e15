"""Encoding and decoding by a word-end BPE tokenizer file: speculate, verify, merge only what fails.

The library merges the best-ranked neighbours of a word until nothing merges.
Here the words of a batch are encoded together, in arrays:

1. *speculate*: the longest token that starts at every position, by one walk of
   all positions through the vocabulary's trie; the tokens met on the way from a
   word's start, longest match by longest match, are its proposal;
2. *verify*: a sequence of tokens is the word's encoding exactly when every
   adjacent pair is compatible, that is, when merging the pair's joined symbols
   ends in just these two.  All pairs are tested at once by undoing merges from
   the border outwards, latest first: the pair is refused as soon as the two
   symbols at the border could have merged before the merge just undone;
3. *merge*: words with a refused pair are merged exactly, rank by rank.

Only tokens that their own symbols merge into are proposed.  White space ends a
word in this kind of file and nothing composes across it, so a text falls into
runs without ASCII white space that are encoded once and remembered.  The file's
own normalizer and word pattern are applied by the library to each new run.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces_of

#: Entries of the younger of the two generations of remembered runs, and of words.
_REMEMBERED = 350_000
#: Symbols of a word up to which a plain list beats a queue.
_SHORT = 48
#: Symbols of new words that are encoded together; a longer word is a block of its own.
_BLOCK = 200_000
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_BYTE_CHARS = 512  # the byte alphabet's characters lie below


class Memory:
    """A dictionary that forgets what was not asked for lately: two generations, the older one is dropped."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys) -> set:
        """Those of ``keys`` that are not known; the others are young from now on."""
        if len(self.young) > _REMEMBERED:
            self.young, self.old = {}, self.young
        new = set(keys).difference(self.young)
        old = self.old
        again = [k for k in new if k in old]
        self.young.update(zip(again, map(old.__getitem__, again), strict=True))
        return new.difference(again)


class WordBpe:
    """Encoder and decoder for the content of one tokenizer file.

    The file must be a BPE model with a word-end suffix and no unknown token, a
    byte alphabet all of whose characters are tokens with and without the suffix,
    and special tokens that match as they are; anything else is a ValueError.
    """

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, library = spec["model"], tokenizers.Tokenizer.from_str(content.decode())
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        suffix = model.get("end_of_word_suffix")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback") if model.get(k)]
        odd += [k for k in ("truncation", "padding", "decoder") if spec.get(k)]
        specials = spec.get("added_tokens") or []
        odd += [k for k in ("single_word", "lstrip", "rstrip", "normalized") for t in specials if t[k]]
        if model["type"] != "BPE" or not suffix or odd:
            raise ValueError(f"not a plain word-end BPE file: {', '.join(odd) or model['type']}")
        self._specials(specials)
        self._vocabulary(model["vocab"], model["merges"], suffix)
        self.names = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in specials}
        self.runs, self.spelled = Memory(), Memory()

    def _specials(self, specials: list[dict]) -> None:
        self.special = {t["content"]: t["id"] for t in specials}
        longest = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def _vocabulary(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        """Tokens numbered by rank: the symbols, then the results of the merges in their order."""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        made = [a + b for a, b in pairs]
        base = sorted(set(vocab) - set(made), key=vocab.get)
        rank = {t: n for n, t in enumerate([*base, *made])}
        if len(rank) != len(vocab) or len(base) + len(made) != len(vocab):
            raise ValueError("every token must be a symbol or come from one merge")
        self.ids = np.array([vocab[t] for t in rank], dtype=np.int32)
        n = len(rank)
        self.left, self.right = np.arange(n, dtype=np.int64), np.arange(n, dtype=np.int64)
        self.left[len(base) :] = [rank[a] for a, _ in pairs]
        self.right[len(base) :] = [rank[b] for _, b in pairs]
        self.n = n
        keys = self.left[len(base) :] * n + self.right[len(base) :]
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = keys[order], order + len(base)
        self.merge_of = dict(zip(self.pair_keys.tolist(), self.pair_made.tolist(), strict=True))
        # Symbols by character: inside a word, and at its end.
        self.symbol = np.full(2 * _BYTE_CHARS, -1, dtype=np.int64)
        for c in tokenizers.pre_tokenizers.ByteLevel.alphabet():
            if c not in rank or c + suffix not in rank or ord(c) >= _BYTE_CHARS:
                raise ValueError(f"the byte alphabet's {c!r} is not a token with and without the suffix")
            self.symbol[ord(c)], self.symbol[_BYTE_CHARS + ord(c)] = rank[c], rank[c + suffix]
        # A token is proposed if its symbols merge into it: both parts do, and nothing joins across
        # their border before their own merge.
        sound = np.ones(n, dtype=bool)
        fits = self.compatible(self.left[len(base) :], self.right[len(base) :], np.arange(len(base), n))
        for t in range(len(base), n):
            sound[t] = fits[t - len(base)] and sound[self.left[t]] and sound[self.right[t]]
        self._trie(len(base), sound)

    def _trie(self, n_base: int, sound: np.ndarray) -> None:
        spelled: list[tuple[int, ...]] = [(t,) for t in range(n_base)]
        for t in range(n_base, self.n):
            spelled.append(spelled[self.left[t]] + spelled[self.right[t]])
        nodes: dict[tuple[int, int], int] = {}
        ends = {}
        for t in np.flatnonzero(sound).tolist():
            at = 0
            for s in spelled[t]:
                at = nodes.setdefault((at, s), len(nodes) + 1)
            ends[at] = t
        self.n_base = n_base
        self.edges = np.array([a * n_base + s for a, s in nodes], dtype=np.int64)
        order = np.argsort(self.edges)
        self.edges, self.targets = self.edges[order], np.array(list(nodes.values()), dtype=np.int64)[order]
        self.token_at = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self.token_at[list(ends)] = list(ends.values())

    def compatible(self, first: np.ndarray, second: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: does nothing merge across its border (by a rank under ``before``, if given)?"""
        a, b = first.copy(), second.copy()
        limit = np.full(len(a), self.n, dtype=np.int64) if before is None else before.copy()
        good = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        while len(at):
            key = a * self.n + b
            i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joined = (self.pair_keys[i] == key) & (self.pair_made[i] < limit)
            good[at[joined]] = False
            # Undo the later of the two last merges at the border; a symbol cannot be undone.
            whole_a, whole_b = self.left[a] == a, self.left[b] == b
            undo_a = ~whole_a & ((a > b) | whole_b)
            go = ~joined & ~(whole_a & whole_b)
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            a, b, limit, at = a[go], b[go], limit[go], at[go]
        return good

    def proposed(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest token at every position (0: ``tokens``) and its length."""
        n = len(symbols)
        best, length = symbols.copy(), np.ones(n, dtype=np.int64)
        alive, node, depth = np.arange(n), np.zeros(n, dtype=np.int64), 0
        while len(alive):
            key = node * self.n_base + symbols[alive + depth]
            i = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[i] == key
            alive, node = alive[hit], self.targets[i[hit]]
            depth += 1
            token = self.token_at[node]
            ends = token >= 0
            best[alive[ends]], length[alive[ends]] = token[ends], depth
            inside = alive + depth < n
            alive, node = alive[inside], node[inside]
        return best, length

    def merged(self, symbols: list[int]) -> list[int]:
        """The plain rule: merge the best-ranked neighbours, the leftmost of equals, until none merges."""
        if len(symbols) > _SHORT:
            return self._merged_long(symbols)
        return self._merged_short(symbols, self._ranks(np.array(symbols, dtype=np.int64)).tolist()[:-1])

    def _ranks(self, symbols: np.ndarray) -> np.ndarray:
        """Rank of each symbol's merge with the next (the number of tokens where there is none)."""
        key = symbols * self.n + np.append(symbols[1:], 0)
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[i] == key, self.pair_made[i], self.n)

    def _merged_short(self, parts: list[int], made: list[int]) -> list[int]:
        """The same, given the ranks of the neighbours' merges; both lists are changed."""
        get, n = self.merge_of.get, self.n
        while made and (best := min(made)) < n:
            i = made.index(best)
            parts[i : i + 2] = [best]
            del made[i]
            if i:
                made[i - 1] = get(parts[i - 1] * n + best, n)
            if i < len(made):
                made[i] = get(best * n + parts[i + 1], n)
        return parts

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a queue."""
        parts = list(symbols)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[int, int, int]] = []

        def offer(i: int, j: int) -> None:
            made = self.merge_of.get(parts[i] * self.n + parts[j])
            if made is not None:
                heapq.heappush(queue, (made, i, j))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            made, i, j = heapq.heappop(queue)
            if parts[i] < 0 or parts[j] < 0 or after[i] != j or self.merge_of.get(parts[i] * self.n + parts[j]) != made:
                continue
            parts[i], parts[j], after[i] = made, -1, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p >= 0]

    def words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word (a non-empty string of the byte alphabet)."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        stops = np.cumsum(lengths)
        starts = stops - lengths
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        chars[stops - 1] += _BYTE_CHARS
        symbols = self.symbol[chars]
        best, length = self.proposed(symbols)
        # Positions that the proposals reach: twice as many hops in every round.
        n = len(symbols)
        hop = np.append(np.arange(n) + length, n)
        reached = np.zeros(n + 1, dtype=bool)
        reached[starts] = True
        while True:
            ahead = hop[np.flatnonzero(reached)]
            if reached[ahead[ahead < n]].all():
                break
            reached[ahead] = True
            hop = hop[hop]
        at = np.flatnonzero(reached[:n])
        tokens, word = best[at], np.searchsorted(stops, at, side="right")
        inner = np.flatnonzero(word[1:] == word[:-1])
        refused = np.unique(word[inner[~self.compatible(tokens[inner], tokens[inner + 1])]])
        packed, bounds = self.ids[tokens].tobytes(), (4 * np.searchsorted(word, np.arange(len(words) + 1))).tolist()
        out = [packed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if len(refused):
            spelled, made = symbols.tolist(), self._ranks(symbols).tolist()
            merged, sizes = [], []
            for w, a, b in zip(refused.tolist(), starts[refused].tolist(), stops[refused].tolist(), strict=True):
                parts = spelled[a:b]
                parts = self._merged_short(parts, made[a : b - 1]) if b - a <= _SHORT else self._merged_long(parts)
                merged += parts
                sizes.append(4 * len(parts))
            packed, at = self.ids[merged].tobytes(), 0
            for w, size in zip(refused.tolist(), sizes, strict=True):
                out[w] = packed[at : at + size]
                at += size
        return out

    def _split(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))

    def _spell(self, runs: list[str]) -> list[list[str | int]]:
        """Words of the byte alphabet, and ids of special tokens, of each run."""
        joined = " ".join(runs)
        if not (self.special_at and self.special_at.search(joined)) and joined.split() == runs:
            # All go through the library in one text; blanks in the normalized text tell them apart.
            text = self.normalizer.normalize_str(joined)
            sizes = np.fromiter(map(len, text.split(" ")), dtype=np.int64)
            if len(sizes) == len(runs):
                found = self.splitter.pre_tokenize_str(text)
                starts = np.fromiter([a for _, (a, _) in found], dtype=np.int64, count=len(found))
                bounds = [0, *np.searchsorted(starts, np.cumsum(sizes + 1)).tolist()]
                words = [w for w, _ in found]
                return [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if len(runs) > 1:  # a special token, or other white space inside a run
            half = len(runs) // 2
            return self._spell(runs[:half]) + self._spell(runs[half:])
        parts = self.special_at.split(runs[0]) if self.special_at else runs
        return [[x for k, part in enumerate(parts) for x in ([self.special[part]] if k % 2 else [w for w, _ in self._split(part)])]]

    def remember(self, runs: list[str]) -> None:
        """Encode new runs and keep their packed ids."""
        spelled = self._spell(runs)
        words = set(itertools.chain.from_iterable(spelled))
        special = words.intersection(self.special.values())
        new, block, size = self.spelled.missing(words - special), [], 0
        known = self.spelled.young
        for word in itertools.chain(new, [None]):
            if block and (word is None or size + len(word) > _BLOCK):
                known.update(zip(block, self.words(block), strict=True))
                block, size = [], 0
            if word is not None:
                block.append(word)
                size += len(word)
        own = {i: np.int32(i).tobytes() for i in special}
        get = (lambda x: own[x] if x in own else known[x]) if own else known.__getitem__
        self.runs.young.update(zip(runs, [b"".join(map(get, out)) for out in spelled], strict=True))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Packed 32-bit ids of each text (none of a null)."""
        split = [_ASCII_SPACE.split(t) if t else [] for t in texts]
        new = list(self.runs.missing(itertools.chain.from_iterable(split)))
        for at in range(0, len(new), 50_000):
            self.remember(new[at : at + 50_000])
        known = self.runs.young.__getitem__
        return [b"".join(map(known, runs)) for runs in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The tokens with a blank between them (such a file has no decoder); ids that name no token have no text."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


@lru_cache(maxsize=1)
def codec_of(content: bytes) -> WordBpe:
    """The codec of a file; a worker process keeps it, and the runs it remembers, from task to task."""
    return WordBpe(content)


def read_tokenizer(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, content: bytes) -> DataFrame:
    """``row`` (struct of all columns of ``docs``), ``ids`` (array of int) and ``decoded`` for every input row.

    ``content`` is a tokenizer file's content (2 MB, sent to the tasks).  Special
    tokens that stand in a text get their own ids, none is added.  A null text
    counts as empty: no ids, empty text.  Repeated rows stay, and any further
    columns of ``docs`` are carried along, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)
    state = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = T.StructType(
        [
            *state.schema.fields,
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches):
        codec = codec_of(shared.value)
        for whole in batches:
            for batch in pieces_of(whole, rows=4096, size=4 << 20):
                packed = codec.encode_batch(pc.struct_field(batch.column("row"), "text").to_pylist())
                ids = np.frombuffer(b"".join(packed), dtype=np.int32)
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int64)
                texts = [codec.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("row"), lists, pa.array(texts, pa.string())], names=schema.names)

    return state.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row of :func:`encode_documents`."""
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
