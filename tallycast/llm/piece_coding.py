"""SentencePiece encoding and decoding by an Aho-Corasick automaton and one Viterbi pass.

The automaton over all pieces reports, at each character, every piece that ends there: the
longest one and, along its output links, the shorter ones. Each of them relaxes the best
score of the prefix it ends. The best path has the largest sum of piece scores; of equal
ones the longer last piece wins. Characters in no piece become byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import document_columns, per_worker, slices_of, table

#: What stands for a blank inside pieces (fixed by the piece format).
BLANK = "▁"
#: Below the worst piece by this much: a character without a piece of its own.
_UNKNOWN_PENALTY = 10.0
_TEXT_BYTES, _CACHED_UNITS = 2_000_000, 300_000


class PieceCoder:
    """Encodes and decodes with the pieces and scores of a model file."""

    def __init__(self, model_file: str, cached_units: int = _CACHED_UNITS):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._automaton = ahocorasick.Automaton()
        self._bytes: list[bytes] = []
        self._byte_ids = [-1] * 256
        self._unknown = model.unk_id()
        self._single: set[str] = set()
        worst, letters, inner = 0.0, set(), False
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self._bytes.append(piece.replace(BLANK, " ").encode())
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self._byte_ids[value] = i
                self._bytes[-1] = bytes([value])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self._bytes[-1] = " ⁇ ".encode() if model.is_unknown(i) else b""
            else:
                score = model.get_score(i)
                self._automaton.add_word(piece, (i, len(piece), score))
                worst = min(worst, score)
                letters.update(piece)
                inner |= BLANK in piece.lstrip(BLANK)
                if len(piece) == 1:
                    self._single.add(piece)
        self._automaton.make_automaton()
        self._unknown_score = worst - _UNKNOWN_PENALTY
        # no piece goes beyond these places, so the best path is that of the units between
        parts = [f"{BLANK}+[^{BLANK}\\n]*", f"[^{BLANK}\\n]+", "\\n"]
        self._units = None if inner or "\n" in letters else re.compile("|".join(parts))
        self._cached: dict[str, bytes] = {}
        self._most = cached_units

    def best_path(self, unit: str) -> list[int]:
        """Ids of the best segmentation of ``unit``, in which blanks are marked."""
        size = len(unit)
        best = [0.0] + [-np.inf] * size
        came: list[tuple[int, int]] = [(0, 0)] * (size + 1)
        single, unknown = self._single, self._unknown_score
        done = 0
        for end, (piece, length, score) in self._automaton.iter(unit):
            while done <= end - 1:  # characters that end no piece still have to be passed
                done += 1
                if unit[done - 1] not in single and best[done - 1] + unknown > best[done]:
                    best[done], came[done] = best[done - 1] + unknown, (done - 1, -1)
            total = best[end + 1 - length] + score
            if total > best[end + 1]:
                best[end + 1], came[end + 1] = total, (end + 1 - length, piece)
        while done < size:
            done += 1
            if unit[done - 1] not in single and best[done - 1] + unknown > best[done]:
                best[done], came[done] = best[done - 1] + unknown, (done - 1, -1)
        path: list[int] = []
        at = size
        while at:
            begin, piece = came[at]
            path.extend([piece] if piece >= 0 else self._fallback(unit[begin]))
            at = begin
        return path[::-1]

    def _fallback(self, character: str) -> list[int]:
        """Byte pieces of a character, last first."""
        ids = [self._byte_ids[b] for b in character.encode("utf-8", "replace")]
        return ids[::-1] if min(ids) >= 0 else [self._unknown]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        marked = BLANK + text.replace(" ", BLANK)
        if self._units is None:
            return np.array(self.best_path(marked), np.int32)
        known = self._cached
        if len(known) > self._most:
            known = self._cached = {}
        out = []
        for unit in self._units.findall(marked):
            ids = known.get(unit)
            if ids is None:
                ids = known[unit] = np.array(self.best_path(unit), np.int32).tobytes()
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; the blank put before the first word is taken off."""
        table = self._bytes
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_pieces(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(<id>, n_tokens, ids, round_trip)``: one row per input row.

    ``round_trip`` says whether decoding the ids gives the text again; it is false only for
    texts that hold the blank mark itself, which stands for a blank. A null or empty text has
    no ids. Repeated rows and ids (null ones too) each give a row, an empty table gives none,
    other columns play no part. Texts are encoded whole, one after the other, so a batch
    holds one long text at most.
    """
    rows = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(f"pieces:{model_file}", lambda: PieceCoder(model_file))
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for run in slices_of(range(len(texts)), pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                plain = texts[run.start : run.stop].to_pylist()
                coded = [coder.encode(text) for text in plain]
                sizes = np.array([len(ids) for ids in coded], np.int64)
                same = [coder.decode(ids) == text for ids, text in zip(coded, plain)]
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*coded, np.zeros(0, np.int32)])))
                yield pa.RecordBatch.from_arrays(
                    [names[run.start : run.stop], pa.array(sizes), lists, pa.array(same)],
                    names=[id_column, "n_tokens", "ids", "round_trip"],
                )

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(encode, f"`{id_column}` {kind}, n_tokens bigint, ids array<int>, round_trip boolean")


def _model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), _model_file())


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as piece ids."""
    return encode_pieces(document_columns(docs), _model_file())
