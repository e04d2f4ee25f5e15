"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

The library merges the best-scored neighbours of a text until nothing merges.
The same ids follow from a table: for every prefix of the text, the last token
of that prefix's encoding is unique.  An Aho-Corasick automaton over the
vocabulary gives the tokens that end at a position; the one to store is the one
that the prefix before it can be followed by, which is a test on two tokens:
merging their joined text must end in just these two.  The ids are then read
backwards from the end of the text.

No vocabulary entry runs on from a word into the next word's marker, so a text
falls into words that are encoded on their own and remembered; a vocabulary
that has such entries is used on whole texts.
"""

from __future__ import annotations

import heapq
import math
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces_of

SPACE = "▁"
_MAX_WORDS = 300_000
_MAX_PAIRS = 200_000
_SHORT = 24


class Codec:
    """Encoder and decoder for one model file (its bytes)."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.pieces = [sp.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.scores = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.ids = {self.pieces[i]: i for i in plain}
        self.bytes_at = {int(self.pieces[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes_at.items()}
        self.surface = [None if sp.is_control(i) or sp.is_byte(i) else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        if self.unk >= 0:
            self.surface[self.unk] = " ⁇ "
        self.chars = {p for p in self.ids if len(p) == 1}
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if self.merged(p) == [p]:  # others never come out of a merge
                self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self.packed = {p: np.array([i], dtype="<u4").tobytes() for p, i in self.ids.items()}
        # Of pairs and words two generations are remembered: what is met again moves to the new one, the rest goes.
        self.pairs: dict[tuple[str, str], bool] = {}
        self.older_pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """The plain rule: merge the best-scored neighbours, the leftmost of equals, until none merges."""
        if len(text) <= _SHORT:
            return self._merged_short(text)
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            if both in self.scores:
                heapq.heappush(queue, (-self.scores[both], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def _merged_short(self, text: str) -> list[str]:
        """The same rule by looking at all neighbours each time: quicker than a queue for a few characters."""
        score, never = self.scores.get, -math.inf
        parts = list(text)
        offers = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while offers:
            best = max(offers)
            if best == never:
                break
            i = offers.index(best)
            parts[i] += parts.pop(i + 1)
            del offers[i]
            if i < len(offers):
                offers[i] = score(parts[i] + parts[i + 1], never)
            if i:
                offers[i - 1] = score(parts[i - 1] + parts[i], never)
        return parts

    def follows(self, first: str, second: str) -> bool:
        """Whether an encoding may hold ``second`` right after ``first`` (remembered in ``pairs``)."""
        if len(self.pairs) >= _MAX_PAIRS:
            self.older_pairs = dict(self.pairs)
            self.pairs.clear()  # not replaced: a text at work holds on to it
        fits = self.older_pairs.get((first, second))
        if fits is None:
            fits = self.merged(first + second) == [first, second]
        self.pairs[first, second] = fits
        return fits

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text of known characters: fill the prefix table, read it backwards."""
        last: list[str | None] = [None] * (len(text) + 1)
        known = self.pairs.get
        for end, (length, token) in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                if end == length:
                    last[end] = token
                elif (fits := known((before := last[end - length], token))) or (fits is None and self.follows(before, token)):
                    last[end] = token
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _ids(self, text: str) -> list[int]:
        if self.chars.issuperset(text):
            return [self.ids[t] for t in self.tokens(text)]
        out: list[int] = []
        run: list[str] = []

        def close() -> None:
            if run:
                out.extend(self.ids[t] for t in self.tokens("".join(run)))
                run.clear()

        for c in text:
            if c in self.chars:
                run.append(c)
                continue
            close()
            out.extend([self.bytes_at[b] for b in c.encode()] if self.bytes_at else [self.unk])
        close()
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; control ids have none, the marker before the first word is dropped."""
        out = self._decode(ids)
        return out[1:] if out.startswith(" ") else out

    def _decode(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            out.append(self.surface[i] or "")
        return "".join(out) + run.decode(errors="replace")

    def _word(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is not None:
            self.known[word] = found
            return found
        if self.chars.issuperset(word):  # its tokens are the word, cut up
            found = self.known[word] = b"".join([self.packed[t] for t in self.tokens(word)])
            return found
        ids = self._ids(word)
        decoded = self._decode(ids)
        if decoded != word.replace(SPACE, " "):
            self.odd[word] = decoded
        found = self.known[word] = np.array(ids, dtype="<u4").tobytes()
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids with begin and end (packed little-endian unsigned 32-bit), and the text they decode to.

        Of a word's decoded text only what differs from the word is remembered.
        """
        if len(self.known) >= _MAX_WORDS:  # between texts, so that the two stay of one mind
            self.older, self.known = self.known, {}
            self.odd = {w: d for w, d in self.odd.items() if w in self.older}
        get, new = self.known.get, self._word
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        words = self.words.findall(marked) if self.by_word else [marked] * bool(marked)
        ids = b"".join([get(w) or new(w) for w in words])
        if self.odd:
            decoded = "".join([self.odd.get(w) or w.replace(SPACE, " ") for w in words])
        else:
            decoded = marked.replace(SPACE, " ")
        ends = np.array([self.bos, self.eos], dtype="<u4").tobytes()
        return ends[:4] + ids + ends[4:], decoded[1:] if decoded.startswith(" ") else decoded


@lru_cache(maxsize=1)
def codec_of(model: bytes) -> Codec:
    """The codec of a model; a worker process keeps it, and the words it remembers, from task to task."""
    return Codec(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """``row`` (struct of all columns of ``docs``), ``n_tokens``, ``ids``, ``decoded`` for every input row.

    ``model`` is the content of a BPE model file that adds a dummy prefix, keeps
    white space and does not normalise (0.5 MB, sent to the tasks).  ``ids`` are
    all ids with begin and end as packed little-endian unsigned 32-bit integers,
    ``decoded`` is the text they decode to.  A null text counts as empty: two
    ids, empty text.  Any further columns of ``docs`` are carried along.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = T.StructType(
        [*state.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    )

    def run(batches):
        codec = codec_of(shared.value)
        for whole in batches:
            for batch in pieces_of(whole):
                found = [codec.encode(t or "") for t in pc.struct_field(batch.column("row"), "text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"),
                        pa.array([len(i) // 4 for i, _ in found], pa.int64()),
                        pa.array([i for i, _ in found], pa.binary()),
                        pa.array([t for _, t in found], pa.string()),
                    ],
                    names=schema.names,
                )

    return state.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row of :func:`encode_documents`."""
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
