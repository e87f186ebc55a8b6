"""Exact encoding with a merge-type (BPE) SentencePiece model, by backtracking."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import lean

SPACE = "▁"
#: Bytes of encoded words that a worker keeps, in two generations of so many.
CACHE_BYTES = 16 << 20
#: Bytes that an entry takes besides its characters and ids: both objects and their place in the table.
ENTRY_BYTES = 200
#: Pairs of pieces whose compatibility a worker keeps.
MAX_FITS = 200_000
#: Rows that are in hand at once.
SLICE = 512


def _escaped(characters: str) -> str:
    return "".join(map(re.escape, characters))


class Encoder:
    """Encodes like the library with the same model: no sampling, no begin or end ids.

    The longest pieces that match are taken from left to right (Aho-Corasick);
    a piece is accepted only if it is compatible with the one before, that is
    if merging their joined characters anew gives just these two. If none of
    the pieces at a position fits, the position is marked as failed, and the
    piece before it gives way to its next shorter prefix. The result whose
    neighbours are all compatible is unique, and is what merging the whole
    text in order of the scores gives.
    """

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        if self.bytes[0] == self.unknown:
            self.bytes = None
        probe = sp.encode("a  b ")  # a plain model: dummy prefix, spaces kept, no rewriting of characters
        if sp.decode(probe) != "a  b " or sp.id_to_piece(sp.encode("x y"))[0][0] != SPACE:
            raise ValueError("only models with a dummy prefix and without normalisation are supported")
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        plain = [p for p in self.ids if p.strip(SPACE) or len(p) == 1]
        if crossing or len({self.score[p] for p in plain if len(p) > 1}) < sum(len(p) > 1 for p in plain):
            raise ValueError("only models whose pieces stay within words and differ in score are supported")
        low = max((self.score[p] for p in self.ids if not p.strip(SPACE) and len(p) > 1), default=None)
        if low is not None and low >= min(self.score[p] for p in plain if len(p) > 1):
            raise ValueError("only models that merge runs of spaces last are supported")
        # pieces of characters only that merging can reach
        self.token = {p: i for p, i in self.ids.items() if (p.strip(SPACE) or len(p) == 1) and (len(p) == 1 or self.merge(p) == [p])}
        self.shorter: dict[str, str | None] = {}
        for p in self.token:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.token), None)
        self.matcher = ahocorasick.Automaton()
        for p in self.token:
            self.matcher.add_word(p, (len(p) - 1, p))
        self.matcher.make_automaton()
        # a run of characters that pieces join, with the spaces before it; a character of no piece stands alone
        runs = "|".join([*(f"[{x}]+" for x in map(_escaped, self._joined()) if x), f"[{_escaped(self._lone())}]"])
        self.words = re.compile(f"{SPACE}+(?:{runs})?|{runs}|.", re.S)
        self.single = {p for p in self.ids if len(p) == 1}
        self.fits: dict[tuple[str, str], bool] = {}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.held = 0  # bytes of ``young``

    def _classes(self) -> list[str]:
        """Characters of the pieces, those together that stand side by side in some piece, directly or over others.

        No piece crosses from one class to another (the space apart), so no
        merge does, and text may be cut there: the runs are encoded on their own.
        """
        parent = {c: c for p in self.ids for c in p if c in self.ids and c != SPACE}

        def find(c: str) -> str:
            while parent[c] != c:
                c = parent[c]
            return c

        for p in self.ids:
            for a, b in zip(p, p[1:]):
                if a in parent and b in parent:
                    parent[find(a)] = find(b)
        out: dict[str, str] = {}
        for c in sorted(parent):
            out[find(c)] = out.get(find(c), "") + c
        return list(out.values())

    def _joined(self) -> list[str]:
        return sorted((x for x in self._classes() if len(x) > 1), key=len, reverse=True)

    def _lone(self) -> str:
        """Characters that no piece joins with others (a private one if there is none, as the pattern needs some)."""
        return "".join(x for x in self._classes() if len(x) == 1) or "\uf8ff"

    def merge(self, text: str) -> list[str]:
        """Join neighbours, the highest score first, then the leftmost, till none has a piece."""
        part: list[str | None] = list(text)
        right = list(range(1, len(part) + 1))
        left = list(range(-1, len(part) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(part) and (joined := part[i] + part[j]) in self.score:
                heapq.heappush(queue, (-self.score[joined], i, joined))

        for i in range(len(part)):
            offer(i)
        while queue:
            _, i, joined = heapq.heappop(queue)
            j = right[i]
            if part[i] is None or j >= len(part) or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            right[i] = right[j]
            if right[i] < len(part):
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in part if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the joined characters of two pieces gives them back; noted in ``fits``."""
        if len(self.fits) >= MAX_FITS:
            self.fits.clear()
        known = self.fits[a, b] = self.merge(a + b) == [a, b]
        return known

    def backtrack(self, word: str) -> list[str]:
        """Pieces of a word, all of whose characters have pieces."""
        n = len(word)
        if word in self.token:
            return [word]
        best: list[str | None] = [None] * n  # the longest piece at each position: matches come by their ends
        for end, (back, p) in self.matcher.iter(word):
            best[end - back] = p
        failed = bytearray(n + 1)
        shorter, fits = self.shorter, self.fits
        out: list[str] = []
        at, last, piece = 0, None, best[0]
        while at < n:
            while piece is not None:
                to = at + len(piece)
                if not failed[to]:
                    if last is None:
                        break
                    good = fits.get((last, piece))
                    if self.compatible(last, piece) if good is None else good:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, last = to, piece
                piece = best[at] if at < n else None
            else:
                failed[at] = 1
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
                piece = shorter[piece]
        return out

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one match of ``words``."""
        body = word.lstrip(SPACE)
        spaces = len(word) - len(body)
        if not body:
            return tuple(self.ids.get(p, self.unknown) for p in self.merge(word))
        if not spaces and body not in self.single and len(body) == 1:
            return tuple(self.bytes[b] for b in body.encode()) if self.bytes else (self.unknown,)
        pieces = self.backtrack((SPACE if spaces else "") + body)
        if spaces > 1:  # runs of spaces merge last, with the word's own space if that stayed alone
            free = 1 if pieces[0] == SPACE else 0
            pieces = self.merge(SPACE * (spaces - 1 + free)) + pieces[free:]
        return tuple(map(self.ids.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        young, old = self.young, self.old
        for w in self.words.findall(SPACE + text.replace(" ", SPACE)):
            ids = young.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    ids = self.word(w)
                if len(w) <= 64:
                    young[w] = ids
                    self.held += ENTRY_BYTES + 2 * len(w) + 8 * len(ids)
                    if self.held >= CACHE_BYTES:
                        self.old, self.young, self.held = young, {}, 0
                        young, old = self.young, self.old
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


_encoders: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    if model not in _encoders:
        _encoders[model] = Encoder(model)
    return _encoders[model]


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) of every whole text.

    The driver reads the model file and sends it along. A null or empty text
    has no ids and decodes to ''. Rows are independent, so repeated rows give
    repeated results, and nothing is shuffled. Extra columns are not read.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    _encoder(model)  # a model of another kind is refused here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                ids = [enc.encode(x) if x else [] for x in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([enc.decode(x) for x in ids], pa.string()),
                    ],
                    names=["key", "ids", "decoded"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(lean(run), f"key {kind}, ids array<int>, decoded string")
        .withColumnRenamed("key", key)
    )
