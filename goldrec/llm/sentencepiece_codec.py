"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is read here (pieces, scores, types, normaliser and
trainer settings) and rebuilt as a ``tokenizers`` pipeline: the normaliser, the
metaspace marker, the unigram scores or, for a BPE model, the merges that its
scores imply, and byte fallback.

No piece of the usual models joins letters and other characters, or runs on
over a marker into the next word.  Where that holds (it is checked when the
model is read), a text's segments - markers and the run of letters or of other
characters behind them - are encoded apart, so a worker encodes each distinct
segment once and new segments go to the library together, as the words of one
input.  Models with pieces that cross segments are encoded by whole texts.  The joined ids of
every row are turned back into their pieces' bytes, and every whole text is
encoded by the ``sentencepiece`` library: ``roundtrip`` and ``parity`` say whether
they agreed with the text and with the joined ids.  ``decode_documents`` decodes
with the ``tokenizers`` library.

Defined results: a null text has null ids, 0 tokens, parity and round trip
true; an empty text has no ids; repeated rows each return; other columns do not
matter.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.llm.common import lean, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 32 << 20
MARK = "▁"
CACHE = 200_000  # segments a worker remembers; the cache starts anew beyond
LEARN = 4096  # segments encoded at a time: the library's own results are many times their ids
RUN = 1 << 18  # characters (or ids) of the texts that are encoded (decoded) at a time


def _kinds(moved: str) -> tuple[str, str]:
    """Patterns of a letter and of another character but the marker; ``moved`` are letters that count as others."""
    more = re.escape(moved)
    return rf"[^\W\d_{more}]", rf"(?:[\d_{more}]|[^\w{MARK}])"


# Field numbers and codes of the SentencePiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, TREAT_SUFFIX, BYTE_FALLBACK = 3, 24, 35
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
UNIGRAM_MODEL, BPE_MODEL = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM_MODEL
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True

    def segments(self) -> re.Pattern | None:
        """Pattern of the segments: no piece holds a marker behind another character, or letters beside others.

        A few letters that pieces hold beside others (say, superscript digits)
        are counted as others; None if that does not settle it.
        """
        if not self.escape_spaces or self.charsmap or self.remove_spaces:
            return None
        pieces, moved = [p for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED)], ""
        for _ in range(8):
            letter, other = _kinds(moved)
            crossing = re.compile(f"({letter}){other}|{other}({letter})|[^{MARK}]{MARK}")
            found = [m for m in map(crossing.search, pieces) if m]
            if not found:
                return re.compile(f"{MARK}*(?:{letter}+|{other}+)|{MARK}+")
            if any(m[0].endswith(MARK) for m in found) or len(moved) > 100:
                return None
            moved = "".join(sorted(set(moved) | {m[1] or m[2] for m in found}))
        return None


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        elif wire == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif wire == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        elif wire == 1:
            yield tag >> 3, struct.unpack("<d", data[at : at + 8])[0]
            at += 8
        else:
            raise ValueError(f"not a SentencePiece model: wire type {wire}")


def read_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == PIECES:
            piece = dict(_fields(value))
            model.pieces.append((piece[PIECE_TEXT].decode(), piece.get(PIECE_SCORE, 0.0), piece.get(PIECE_TYPE, NORMAL)))
        elif number == TRAINER:
            trainer = dict(_fields(value))
            model.kind = trainer.get(MODEL_TYPE, UNIGRAM_MODEL)
            model.byte_fallback = bool(trainer.get(BYTE_FALLBACK, 0))
            model.suffix = bool(trainer.get(TREAT_SUFFIX, 0))
        elif number == NORMALIZER:
            spec = dict(_fields(value))
            model.charsmap = spec.get(CHARSMAP, b"")
            model.dummy_prefix = bool(spec.get(DUMMY_PREFIX, 1))
            model.remove_spaces = bool(spec.get(REMOVE_SPACES, 1))
            model.escape_spaces = bool(spec.get(ESCAPE_SPACES, 1))
    if model.kind not in (UNIGRAM_MODEL, BPE_MODEL) or model.suffix or not model.escape_spaces:
        raise ValueError("only unigram and BPE models with a marker before the word are rebuilt")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """The merges that a BPE model's scores imply: best score first; of equal scores the longer left part, as the leftmost pair is joined first."""
    scores = {p: s for p, s, t in model.pieces if t in (NORMAL, USER_DEFINED)}
    found = [
        (-score, -cut, piece[:cut], piece[cut:])
        for piece, score in scores.items()
        for cut in range(1, len(piece))
        if piece[:cut] in scores and piece[cut:] in scores
    ]
    return [(a, b) for _, _, a, b in sorted(found)]


def build_tokenizer(model: Model, whole_texts: bool = True):
    """The tokenizers pipeline; without ``whole_texts`` it takes segments that are normalised already."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next((i for i, (_, _, t) in enumerate(model.pieces) if t == UNKNOWN), None)
    if model.kind == BPE_MODEL:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        bpe = models.BPE(vocab, merges_of(model), unk_token=None if unknown is None else model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
        out = Tokenizer(bpe)
    else:
        out = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback))
    if whole_texts:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.remove_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        steps += [normalizers.Prepend(MARK)] if model.dummy_prefix else []
        out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    parts = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")]
    out.decoder = decoders.Sequence(parts + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return out


class Codec:
    """One worker's encoder and decoder."""

    def __init__(self, data: bytes):
        import numpy as np
        import pyarrow as pa
        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core: threads cost it time and memory
        self.model = read_model(data)
        # one pipeline is enough: the decoder is the same for segments and whole texts
        self.segments = self.model.segments()
        self.backend = build_tokenizer(self.model, whole_texts=self.segments is None)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.known: dict[str, bytes] = {}  # ids as int32
        self.bytes_of = pa.array([self._bytes(p, t) for p, _, t in self.model.pieces], pa.binary())
        # bytes of a normalised text that a piece takes; the unknown one takes any
        self.takes = np.array([0 if t == UNKNOWN else 1 if t == BYTE else len(p.encode()) for p, _, t in self.model.pieces], np.int64)

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        """What a piece stands for in a text."""
        return bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode()

    def _gives(self, ids, text: str) -> bool:
        """Whether ``ids`` decode to ``text``: their pieces' bytes, joined, without the space of the marker before the text."""
        import pyarrow as pa

        parts = self.bytes_of.take(pa.array(ids, pa.int32()))
        joined = parts.buffers()[2].to_pybytes() if len(parts) else b""
        if self.model.dummy_prefix and joined[:1] == b" ":
            joined = joined[1:]
        return joined == text.encode()

    def _fast(self, texts: list[str]) -> list[list[int]]:
        encode = getattr(self.backend, "encode_batch_fast", self.backend.encode_batch)  # the fast one leaves out offsets
        return [e.ids for e in encode(texts, add_special_tokens=False)]

    def _ids_of(self, segments: list[str]) -> Iterator[bytes]:
        """ids (int32 bytes) of every segment.

        As words of one input they give one result, which costs less than one a
        segment; where a segment ends in it follows from the bytes that its pieces
        take.  Where that does not come out (unknown pieces), each is encoded by itself.
        """
        import numpy as np

        encode = getattr(self.backend, "encode_batch_fast", self.backend.encode_batch)
        (got,) = encode([segments], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(got.ids, np.int32)
        takes = self.takes[ids]
        ends, wanted = np.cumsum(takes), np.cumsum([len(s.encode()) for s in segments])
        cuts = np.searchsorted(ends, wanted)
        if not len(ids) or not takes.all() or ends[-1] != wanted[-1] or (ends[cuts] != wanted).any():
            return (array("i", i).tobytes() for i in self._fast(segments))
        raw, to = ids.tobytes(), ((cuts + 1) * 4).tolist()
        return (raw[a:b] for a, b in zip([0, *to], to))

    def _by_segments(self, texts: list[str]) -> list[bytes]:
        """ids of every text, joined from those of its segments."""
        lead = MARK if self.model.dummy_prefix else ""
        cut = [self.segments.findall((lead + t).replace(" ", MARK)) if t else [] for t in texts]
        known = self.known
        wanted = set().union(*cut)
        new = list(wanted.difference(known))
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(wanted)
        for at in range(0, len(new), LEARN):
            part = new[at : at + LEARN]
            known.update(zip(part, self._ids_of(part)))
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def encode_rows(self, texts: list[str | None]) -> tuple[list[bytes | None], list[bool], list[bool]]:
        """ids (int32 bytes), parity and round trip of every text."""
        import numpy as np

        filled = [t or "" for t in texts]
        if self.segments is None:
            rows = [array("i", g if t else []).tobytes() for t, g in zip(filled, self._fast(filled))]
        else:
            rows = self._by_segments(filled)
        parity, roundtrip = [], []
        for text, row in zip(filled, rows):  # one by one: a list of texts goes to a thread of its own, whose memory is fetched anew each time
            parity.append(array("i", self.other.encode(text)).tobytes() == row)
            roundtrip.append(self._gives(np.frombuffer(row, np.int32), text))
        return [None if t is None else r for t, r in zip(texts, rows)], parity, roundtrip

    def encode(self, texts: list[str | None]) -> tuple[list, list[bool]]:
        """ids and parity of every text."""
        rows, parity, _ = self.encode_rows(texts)
        return [None if r is None else list(array("i", r)) for r in rows], parity

    def decode(self, ids: list) -> list[str | None]:
        out = self.backend.decode_batch([i or [] for i in ids], skip_special_tokens=False)
        return [None if i is None else t for i, t in zip(ids, out)]


def model_bytes(path: str = MODEL) -> bytes:
    """The model, read on the driver; it travels to the workers, so they need no file."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return data


def _rows(batch, at: int, size: int = RUN) -> Iterator[tuple[int, list]]:
    """Runs of rows with about ``size`` characters or ids: (first row, values)."""
    first, held, total = 0, [], 0
    for i, v in enumerate(batch.column(at)):
        v = v.as_py()
        if held and total + len(v or "") > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(v)
        total += len(v or "")
    if held:
        yield first, held


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_tokens, parity, roundtrip) for every row; roundtrip: the ids decode to the text."""
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        codec = Codec(data.value)
        for b in batches:
            for first, texts in _rows(b, 1):
                rows, parity, roundtrip = codec.encode_rows(texts)
                sizes = np.array([len(r or b"") // 4 for r in rows], np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                offsets = pa.array(ends.astype(np.int32), mask=np.array([*(r is None for r in rows), False]))
                flat = pa.array(np.frombuffer(b"".join(r or b"" for r in rows), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(offsets, flat), pa.array(sizes), pa.array(parity), pa.array(roundtrip)],
                    names=["doc_id", "ids", "n_tokens", "parity", "roundtrip"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(lean(run), f"doc_id {kind}, ids array<int>, n_tokens long, parity boolean, roundtrip boolean")


def decode_documents(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    spark: SparkSession = tokens.sparkSession
    data = spark.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = Codec(data.value)
        for b in batches:
            for first, ids in _rows(b, 1):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(ids)), pa.array(codec.decode(ids), pa.string())], names=["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(lean(run), f"doc_id {kind}, text string")


ship(__name__)
