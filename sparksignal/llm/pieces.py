"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces proposes, the model's own rule chooses.

Reading a text character by character, the automaton's state is the longest piece prefix that ends
here; its output links give every piece that ends here, longest first.

* Unigram models (scores are log-probabilities): each proposed piece relaxes the best score of this position from the
  position where it starts, a Viterbi pass.  The best segmentation has the highest sum of piece scores; of equal sums
  the longer last piece wins.
* BPE models (scores are merge ranks, and sums mean nothing): of the neighbours whose union is a proposed piece
  the pair with the highest score is merged, the leftmost of equal ones, until none is left.

Other model types, and BPE models with unused or user-defined pieces, are refused.

Spaces become U+2581 and one is put before the text, as the models do.  No piece has U+2581 after another
character (checked on load), so no segmentation crosses from a character to a following U+2581; and where no piece has a
letter beside a sign that is none (checked, too), none crosses there.  The text falls into units at these places, which
are encoded each for itself, and frequent units are kept in a bounded cache per worker.  A character without a piece (in Viterbi: at ten less than the worst normal
score) becomes the byte pieces of its UTF-8; a U+2581 of the text itself is such a character, so that every
text decodes to itself.

Cases: null or empty texts have no pieces and decode to an empty text; repeated rows are encoded each; a very
long unit needs memory in proportion to it; unknown ids cannot be decoded (error); an empty
table gives an empty result; the other columns come back in ``row``.
"""

from __future__ import annotations

import re
import threading
from collections import deque
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm.chunks import row_of

SPACE = "▁"
OWN_SPACE = "\udfff"  # a U+2581 of the text; lone surrogates never occur in texts
UNKNOWN_COST = 10
CACHE_UNITS, LONG_UNIT, SLICE_ROWS = 250_000, 64, 256
LETTER = re.compile("[^\\W\\d_²³¹]")
UNIT = re.compile(r" +[^ ]*")  # spaces, then what follows
FINER = re.compile(r" *(?:[^\W\d_²³¹]+|(?:[^\w ]|[\d_²³¹])+)| +$")  # and cut between a letter and a sign that is none


def load_model(path: str) -> tuple[list[str], list[float], list[int], bool]:
    """Pieces, scores, for each byte the id of its byte piece, and whether it is a BPE model; read by the driver."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    if n > 1 << 20:
        raise ValueError("a model has 2**20 pieces at most")
    names, scores, byte_ids = [], [], [-1] * 256
    for i in range(n):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        plain = not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        names.append(p if plain else "")
        scores.append(m.get_score(i))
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces")
    if any(SPACE in p.lstrip(SPACE) for p in names):
        raise ValueError("a piece has a space inside")
    spec = pb.ModelProto.FromString(m.serialized_model_proto())
    kind = spec.trainer_spec.model_type
    if kind not in (pb.TrainerSpec.UNIGRAM, pb.TrainerSpec.BPE):
        raise ValueError("only unigram and BPE models are known")
    bpe, piece = kind == pb.TrainerSpec.BPE, pb.ModelProto.SentencePiece
    if bpe and any(p.type in (piece.UNUSED, piece.USER_DEFINED) for p in spec.pieces):
        raise ValueError("a BPE model with unused or user-defined pieces")
    return names, scores, byte_ids, bpe


class Encoder:
    """The automaton, and a cache of units; one instance per worker and model."""

    _own = threading.local()

    def __init__(self, model):
        names, self.scores, self.byte_ids, bpe = model
        self.segment = self.merges if bpe else self.viterbi
        self.next: list[dict[str, int]] = [{}]
        self.piece, depth = [-1], [0]
        for i, p in enumerate(names):
            at = 0
            for c in p:
                nxt = self.next[at].get(c)
                if nxt is None:
                    nxt = self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.piece.append(-1)
                    depth.append(depth[at] + 1)
                at = nxt
            if p and self.piece[at] < 0:
                self.piece[at] = i
        n = len(self.next)
        self.fail = [0] * n
        self.outputs: list[tuple] = [()] * n  # (length, score, id) of the pieces that end here, longest first
        todo = deque([0])
        while todo:
            v = todo.popleft()
            for c, u in self.next[v].items():
                todo.append(u)
                f = self.fail[v]
                while f and c not in self.next[f]:
                    f = self.fail[f]
                self.fail[u] = self.next[f][c] if v and c in self.next[f] else 0
                out = self.outputs[self.fail[u]]
                i = self.piece[u]
                self.outputs[u] = ((depth[u], self.scores[i], i), *out) if i >= 0 else out
        self.unknown = min(s for s, p in zip(self.scores, names) if p and s > -1e8) - UNKNOWN_COST
        self.singles = set(self.next[0]) & {p for p in names if len(p) == 1}
        apart = all(bool(LETTER.match(a)) == bool(LETTER.match(b)) for p in names for a, b in zip(p, p[1:]) if a != SPACE)
        self.units = FINER if apart else UNIT
        self.young, self.old = {}, {}

    @classmethod
    def of(cls, key, model) -> Encoder:
        if getattr(cls._own, "key", None) != key:
            cls._own.key, cls._own.got = key, cls(model)
        return cls._own.got

    def viterbi(self, unit: str) -> list[int]:
        """Ids of the best segmentation of a unit (spaces as U+2581)."""
        nxt, fail, outputs, singles, unknown = self.next, self.fail, self.outputs, self.singles, self.unknown
        best, back, v = [0.0], [None], 0
        for i, c in enumerate(unit, 1):
            while v and c not in nxt[v]:
                v = fail[v]
            v = nxt[v].get(c, 0)
            top = from_ = None
            for size, score, piece in outputs[v]:
                s = best[i - size] + score
                if top is None or s > top:
                    top, from_ = s, (size, piece)
            if c not in singles:
                s = best[i - 1] + unknown
                if top is None or s > top:
                    top, from_ = s, (1, -1)
            best.append(top)
            back.append(from_)
        out, i = [], len(unit)
        while i:
            size, piece = back[i]
            if piece >= 0:
                out.append(piece)
            else:
                c = unit[i - 1]
                out += [self.byte_ids[b] for b in reversed((SPACE if c == OWN_SPACE else c).encode())]
            i -= size
        return out[::-1]

    def merges(self, unit: str) -> list[int]:
        """Ids of a unit (spaces as U+2581) by the merge order of a BPE model."""
        nxt, fail, outputs = self.next, self.fail, self.outputs
        proposed, v, n = {}, 0, len(unit)  # (start, end) -> (-score, id)
        for i, c in enumerate(unit, 1):
            while v and c not in nxt[v]:
                v = fail[v]
            v = nxt[v].get(c, 0)
            for size, score, piece in outputs[v]:
                proposed[i - size, i] = -score, piece
        end, start = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that starts, or ends, here
        heap = [(proposed[i, i + 2][0], i, i + 1, i + 2) for i in range(n - 1) if (i, i + 2) in proposed]
        heapify(heap)
        while heap:
            _, a, m, z = heappop(heap)
            if end[a] != m or end[m] != z:
                continue  # one of the two has been merged since
            end[a], end[m], start[z] = z, -1, a
            if a:
                got = proposed.get((start[a], z))
                if got:
                    heappush(heap, (got[0], start[a], a, z))
            if z < n:
                got = proposed.get((a, end[z]))
                if got:
                    heappush(heap, (got[0], a, z, end[z]))
        out, i = [], 0
        while i < n:
            got = proposed.get((i, end[i]))
            if got:
                out.append(got[1])
            else:
                c = unit[i]
                out += [self.byte_ids[b] for b in (SPACE if c == OWN_SPACE else c).encode()]
            i = end[i]
        return out

    def unit(self, u: str) -> bytes:
        got = self.old.get(u)
        if got is None:
            got = np.array(self.segment(u.replace(SPACE, OWN_SPACE).replace(" ", SPACE)), "<u4").tobytes()
        if len(u) <= LONG_UNIT:
            self.young[u] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if len(self.young) > CACHE_UNITS:
            self.young, self.old = {}, self.young
        get, make = self.young.get, self.unit
        return b"".join([get(u) or make(u) for u in self.units.findall(" " + text)])


def _mapped(rows: DataFrame, col: str, cast: str, make, names_types: str) -> DataFrame:
    """``row`` and the columns that ``make()`` (called once a task) derives from ``col``."""
    src = rows.select(row_of(rows, col), F.col(f"`{col}`").cast(cast).alias("t"))
    schema = T.StructType([src.schema["row"], *T.StructType.fromDDL(names_types).fields])

    def run(batches):
        one = make()
        for b in batches:
            for lo in range(0, len(b), SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), *one(part.column(1).to_pylist())], schema.names)

    return src.mapInArrow(run, schema)


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the other columns), ``ids`` (binary, 4 bytes an id), ``n_pieces``."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path))  # a vocabulary: size checked

    def make():
        coder = Encoder.of(model_path, model.value)

        def one(texts):
            ids = [coder.encode(t or "") for t in texts]
            return pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())

        return one

    return _mapped(docs, text_col, "string", make, "ids binary, n_pieces long")


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``row`` (struct of the other columns) and ``text`` of encoded ids."""
    names, _, byte_ids, _ = load_model(model_path)
    table = [p.replace(SPACE, " ").encode() for p in names]
    for b, i in enumerate(byte_ids):
        table[i] = bytes([b])
    table = rows.sparkSession.sparkContext.broadcast(table)

    def make():
        piece = pa.array(table.value, pa.large_binary())

        def one(ids):
            ids = [x or b"" for x in ids]
            got = piece.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
            ends = np.frombuffer(got.buffers()[1], np.int64) if len(got) else np.zeros(1, np.int64)
            cuts = ends[np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])].tolist()
            data = memoryview(got.buffers()[2] or b"")
            return (pa.array([bytes(data[a:z]).removeprefix(b" ").decode("utf-8", "replace") for a, z in zip(cuts, cuts[1:])], pa.string()),)

        return one

    return _mapped(rows, ids_col, "binary", make, "text string")
