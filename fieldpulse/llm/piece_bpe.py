"""SentencePiece encoding and decoding, exact for merge-type models, by backtracking.

A merge-type model joins, again and again, the adjacent pair of symbols whose joint piece has the best
score (the leftmost of equals). Its result is the only sequence of pieces in which every adjacent pair is
*compatible*: merging the characters of the two pieces alone gives the same two pieces. So no merge of the
whole text is simulated. Aho-Corasick gives the longest piece that starts at each place; the search takes
it, falls back to shorter pieces where it doesn't go with the piece before, and steps back where none does.
A bitfield remembers the places no valid continuation was found from, so no place is searched twice.

A text is cut before each run of the space mark first. No piece has the mark behind another character (this
is checked when the model is read; else a text stays in one part), so no merge reaches over a cut, and
parts can be remembered between texts.

Whole texts are encoded; nothing is looked at twice and a text's working arrays are in proportion to its
longest part. Null text: null ids (the query reads null as empty). Empty text: no ids. A character that no
piece holds becomes its UTF-8 bytes' pieces. Models with user-defined or unused pieces, or with another
normalisation than a space put in front and spaces written as the mark, are refused.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from fieldpulse.llm._common import map_batches, read_table, slices

MARK = "▁"  # stands for a space in pieces
#: Parts and pairs remembered by a task (a memory is emptied when full), and the longest part remembered.
REMEMBERED, REMEMBERED_PAIRS, REMEMBERED_CHARS = 300_000, 250_000, 48
NEVER = float("-inf")  # the score of what is no piece
#: Values worked on at once, in bytes of text or in ids (one value at least).
BATCH_UNITS = 4_000_000


class PieceBpe:
    """Encoder and decoder of one model, given as its file's bytes."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("not a merge-type model with byte pieces and the mark in front of words")
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the model normalises texts")
        kinds = spec.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = np.zeros(256, dtype=np.int32)
        table: list[bytes] = []
        marked: list[bool] = []
        for i, p in enumerate(spec.pieces):
            marked.append(p.type == kinds.NORMAL and p.piece.startswith(MARK))
            if p.type == kinds.NORMAL:
                self.id[p.piece], self.score[p.piece] = i, p.score
                table.append(p.piece.replace(MARK, " ").encode())
            elif p.type == kinds.BYTE:
                byte = int(p.piece[3:-1], 16)
                self.byte_id[byte] = i
                table.append(bytes([byte]))
            elif p.type in (kinds.CONTROL, kinds.UNKNOWN):
                table.append(b" \xe2\x81\x87 " if p.type == kinds.UNKNOWN else b"")
            else:
                raise ValueError("user-defined and unused pieces are not supported")
        self.bytes_of = table
        self._marked = np.array(marked)
        self.length_of = np.array([len(b) for b in table], dtype=np.int64)
        self._flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        self._start = np.concatenate(([0], np.cumsum(self.length_of)[:-1]))
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        # the longest piece that is a proper front part of a piece (0: none)
        self.shorter = {p: next((k for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), 0) for p in self.id}
        joined = {c for p in self.id if len(p) > 1 for c in p}
        apart = "".join(c for c in "\n\t\r" if c not in joined)  # never part of a longer piece
        whole = any(MARK in p.lstrip(MARK) for p in self.id)
        self.parts = re.compile(r"(?s).+" if whole else f"{MARK}+[^{MARK}{apart}]*|[^{MARK}{apart}]+" + (f"|[{apart}]" if apart else ""))
        self._packed = {p: np.int32(i).tobytes() for p, i in self.id.items()}
        self._fits: dict[tuple[str, str], bool] = {}
        self._memory: dict[str, bytes] = {}

    # -- the library's rule, used for pairs of pieces

    def merged(self, text: str) -> list[str]:
        """The symbols left when no adjacent pair of them is a piece. For short texts: a step looks through
        all that is left."""
        of = self.score.get
        sym = list(text)
        best = [of(a + b, NEVER) for a, b in zip(sym, sym[1:])]
        while best:
            top = max(best)
            if top == NEVER:
                break
            i = best.index(top)
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
            del best[i]
            if i:
                best[i - 1] = of(sym[i - 1] + sym[i], NEVER)
            if i < len(best):
                best[i] = of(sym[i] + sym[i + 1], NEVER)
        return sym

    def fit(self, a: str, b: str) -> bool:
        """Whether ``b`` can follow ``a``: merging the two gives them back. ``a`` empty: ``b`` alone."""
        if len(self._fits) >= REMEMBERED_PAIRS:
            self._fits.clear()
        known = self._fits[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def search(self, part: str) -> list[str]:
        """Pieces of a part by backtracking; a character in no piece stands alone."""
        n = len(part)
        longest = [1] * n
        for end, size in self.automaton.iter(part):  # ends come in order, so the last match of a start is its longest
            longest[end - size + 1] = size
        fits, shorter = self._fits, self.shorter
        failed = None  # a bit a place
        out: list[str] = []
        at, size, before = 0, longest[0] if n else 0, ""
        while at < n:
            while size:
                end = at + size
                piece = part[at:end]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    ok = fits.get((before, piece))
                    if ok or (ok is None and self.fit(before, piece)):
                        out.append(piece)
                        at, before = end, piece
                        size = longest[at] if at < n else 0
                        break
                size = shorter.get(piece, 0)
            else:
                if not out:
                    raise AssertionError("no sequence of pieces")
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
                size, before = shorter.get(last, 0), out[-1] if out else ""
        return out

    def part_ids(self, part: str) -> bytes:
        """Ids of one part as 32-bit integers."""
        known = self._memory.get(part)
        if known is not None:
            return known
        pieces = self.search(part)
        try:
            got = b"".join(map(self._packed.__getitem__, pieces))
        except KeyError:  # characters in no piece
            got = b"".join(self._packed.get(p) or self.byte_id[list(p.encode())].tobytes() for p in pieces)
        if len(part) <= REMEMBERED_CHARS:
            if len(self._memory) >= REMEMBERED:
                self._memory.clear()
            self._memory[part] = got
        return got

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers."""
        return b"".join(map(self.part_ids, self.parts.findall(MARK + text.replace(" ", MARK)))) if text else b""

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype=np.int32)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The pieces' bytes joined, marks as spaces, the space in front included."""
        sizes = self.length_of[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._start[ids] - ends + sizes, sizes) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces joined, without the space that encoding puts in front of the first piece that
        has any bytes (control ids have none). Each byte that is part of no character becomes U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        raw = self.decode_bytes(ids).tobytes()
        said = np.flatnonzero(self.length_of[ids])
        if len(said) and self._marked[ids[said[0]]]:
            raw = raw[1:]
        return raw.decode(errors="each-byte")


codecs.register_error("each-byte", lambda e: ("\ufffd", e.start + 1))

_LOADED: dict[bytes, PieceBpe] = {}


def loaded(model: bytes) -> PieceBpe:
    """One encoder a Python worker and model."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED[key] = PieceBpe(model)
    return _LOADED[key]


def model_bytes(model: str | bytes) -> bytes:
    """A model file by its path on the driver (its bytes go to the tasks: a vocabulary, not data)."""
    if isinstance(model, bytes):
        return model
    with open(model, "rb") as f:
        return f.read()


def _mapped(df: DataFrame, column: str, made: str, kind, fn, keep: bool) -> DataFrame:
    """``df`` with a column ``made`` of ``fn(values)``. Columns pass by position, so any name will do."""
    fields = [f for f in df.schema.fields if f.name != made and (keep or f.name != column)]
    inner = df.select(F.col(f"`{column}`").alias("value"), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    names = [f"c{i}" for i in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0)
            for lo, hi in slices(_sizes(values), BATCH_UNITS):
                rest = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*rest, fn(values.slice(lo, hi - lo))], [*names, "made"])

    schema = StructType([*[StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)], StructField("made", kind)])
    return map_batches(inner, run, schema).select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)], F.col("made").alias(made))


def _sizes(values: pa.Array) -> list[int]:
    size = pc.list_value_length(values) if pa.types.is_list(values.type) or pa.types.is_large_list(values.type) else pc.binary_length(values)
    return pc.fill_null(size, 0).to_pylist()


def id_lists(got: list[np.ndarray | None]) -> pa.Array:
    """Arrays of ids as an Arrow list column."""
    ends = np.cumsum([0, *(0 if g is None else len(g) for g in got)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *(g for g in got if g is not None)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=pa.array([g is None for g in got]))


def encode(df: DataFrame, model: str | bytes, text: str = "text", ids: str = "ids", keep_text: bool = True) -> DataFrame:
    """``df`` with the ids of a text column as ``ids array<int>`` (an equal-named column is replaced)."""
    proto = model_bytes(model)

    def run(values: pa.Array) -> pa.Array:
        bpe = loaded(proto)
        return id_lists([None if t is None else bpe.encode(t) for t in values.to_pylist()])

    return _mapped(df, text, ids, ArrayType(IntegerType()), run, keep_text)


def decode(df: DataFrame, model: str | bytes, ids: str = "ids", text: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """``df`` with the text of an ids column (null: null) as column ``text`` (an equal-named one is replaced)."""
    proto = model_bytes(model)

    def run(values: pa.Array) -> pa.Array:
        bpe = loaded(proto)
        flat, ends = values.flatten().to_numpy(zero_copy_only=False), np.cumsum(_sizes(values))
        starts = np.concatenate(([0], ends[:-1]))
        return pa.array([None if gone else bpe.decode(flat[a:b]) for a, b, gone in zip(starts, ends, values.is_null().to_pylist())], pa.string())

    return _mapped(df, ids, text, StringType(), run, keep_ids)


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    made = decode(encode(docs, model, keep_text=False), model)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
