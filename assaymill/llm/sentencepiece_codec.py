"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file's protobuf is read here, and its normaliser, word marker, piece scores and byte
fallback are rebuilt: unigram models with their scores, BPE models with merges ranked by the
score of the merged piece. Where no piece holds a marker behind another character, pieces
can't cross the start of a marked word; words are then encoded one by one, each distinct word
once per worker, which gives the same ids as encoding whole texts. Otherwise whole texts are
encoded.

NULL texts give NULL ids; the empty text gives no ids. Texts that hold the marker itself decode
to spaces there, as the format has it; ``round_trip`` is false for them. The same goes for
texts that the model's normaliser changes.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from assaymill.llm.common import append_columns, chunks

MARK = "▁"
# Fixed values of the model format: field numbers and piece and model types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words after which a worker starts a new half of its cache.
CACHE_WORDS = 500_000
#: Words handed to the libraries at a time; their results are large objects.
WORD_BLOCK = 8_192


@dataclass
class Piece:
    text: str
    score: float
    kind: int


@dataclass
class SentencePieceModel:
    pieces: list[Piece]
    model_type: int
    byte_fallback: bool
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    escape_whitespaces: bool
    charsmap: bytes


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> SentencePieceModel:
    pieces: list[Piece] = []
    trainer: dict = {}
    normalizer: dict = {}
    for number, value in _fields(data):
        if number == PIECES:
            f = dict(_fields(value))
            score = struct.unpack("<f", f.get(2, b"\0\0\0\0"))[0]
            pieces.append(Piece(f.get(1, b"").decode(), score, f.get(3, NORMAL)))
        elif number == TRAINER:
            trainer = dict(_fields(value))
        elif number == NORMALIZER:
            normalizer = dict(_fields(value))
    return SentencePieceModel(
        pieces,
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        bool(normalizer.get(5, 1)),
        normalizer.get(2, b""),
    )


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver; a vocabulary of some 100 KB goes to tasks as bytes."""
    with open(path, "rb") as f:
        return f.read()


def _merges(pieces: Sequence[Piece], vocab: dict[str, int]) -> list[tuple[str, str]]:
    """Pairs that merge into a piece, best piece first."""
    usable = {p.text for p in pieces if p.kind in (NORMAL, UNUSED)}
    ranked = []
    for p in pieces:
        if p.kind != NORMAL:
            continue
        for k in range(1, len(p.text)):
            left, right = p.text[:k], p.text[k:]
            if left in usable and right in usable:
                ranked.append((-p.score, vocab[left], vocab[right], left, right))
    return [(left, right) for *_, left, right in sorted(ranked)]


def build_tokenizer(model: SentencePieceModel, prefix: bool = True) -> Tokenizer:
    """The whole tokenizer; without ``prefix`` one for words that carry their marker already."""
    vocab = {p.text: i for i, p in enumerate(model.pieces)}
    unknown = next((i for i, p in enumerate(model.pieces) if p.kind == UNKNOWN), 0)
    if model.model_type == UNIGRAM:
        core = models.Unigram([(p.text, p.score) for p in model.pieces], unknown, model.byte_fallback)
    elif model.model_type == BPE:
        core = models.BPE(
            vocab=vocab,
            merges=_merges(model.pieces, vocab),
            unk_token=model.pieces[unknown].text,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.model_type} is not supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tail = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail]
    )
    own = [AddedToken(p.text, normalized=False) for p in model.pieces if p.kind == USER_DEFINED]
    if own:
        tokenizer.add_tokens(own)
    return tokenizer


def words_are_independent(model: SentencePieceModel) -> bool:
    """Whether no piece crosses the start of a marked word and the text is taken as it is."""
    return (
        not model.charsmap
        and not model.remove_extra_whitespaces
        and model.add_dummy_prefix
        and model.escape_whitespaces
        and all(p.kind != USER_DEFINED for p in model.pieces)
        and all(MARK not in p.text.lstrip(MARK) for p in model.pieces)
    )


_MARKED = re.compile(" +[^ ]*")


class Codec:
    """Encodes and decodes lists of texts, with the parity of the original library at hand."""

    def __init__(self, data: bytes, threads: int = 1):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        model = parse_model(data)
        self.whole = build_tokenizer(model)
        self.by_word = words_are_independent(model)
        self.words = build_tokenizer(model, prefix=False) if self.by_word else None
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.threads = threads
        # Ids by word in two halves, and the words of the newer half that stand out.
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._unequal: set[str] = set()
        self._changed: set[str] = set()
        self._odd: set[str] = set()  # of the older half; they are learned again

    def encode(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, bool, bool] | None]:
        """Per text its ids, whether the original library gives the same, and whether they
        decode to the text."""
        out: list[tuple[np.ndarray, bool, bool] | None] = []
        for a, b in chunks(texts, 500_000):
            out += (self._encode_words if self.by_word else self._encode_whole)(texts[a:b])
        return out

    def decode(self, ids: Sequence[Sequence[int]]) -> list[str]:
        return self.whole.decode_batch([list(map(int, x)) for x in ids], skip_special_tokens=False)

    def _encode_whole(self, texts):
        given = [t or "" for t in texts]
        ids = [e.ids for e in self.whole.encode_batch(given, add_special_tokens=False)]
        other = self.original.encode(given, num_threads=self.threads)
        back = self.decode(ids)
        return [
            None if t is None else (np.array(i, np.int32), i == o, d == t)
            for t, i, o, d in zip(texts, ids, other, back)
        ]

    def _encode_words(self, texts):
        if len(self._known) > CACHE_WORDS:  # words in use come back from the older half
            self._older, self._known = self._known, {}
            self._odd = self._unequal | self._changed
            self._unequal, self._changed = set(), set()
        known, older = self._known, self._older
        split = [_MARKED.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        fresh = []
        for w in set(chain.from_iterable(split)):
            if w not in known:
                if w in older and w not in self._odd:
                    known[w] = older[w]
                else:
                    fresh.append(w)
        for at in range(0, len(fresh), WORD_BLOCK):
            self._learn(fresh[at : at + WORD_BLOCK])
        out = []
        for t, ws in zip(texts, split):
            if t is None:
                out.append(None)
                continue
            ids = np.frombuffer(b"".join(map(known.__getitem__, ws)), np.int32)
            parity = not self._unequal or self._unequal.isdisjoint(ws)
            same = MARK not in t and (not self._changed or self._changed.isdisjoint(ws))
            out.append((ids, parity, same))
        return out

    def _learn(self, words: list[str]) -> None:
        """Encode words, compare with the original library, and decode them again."""
        ids = [e.ids for e in self.words.encode_batch_fast(words, add_special_tokens=False)]
        # The original sees the word without the blank that it puts in front itself.
        other = self.original.encode([w[1:] for w in words], num_threads=self.threads)
        for w, i, o in zip(words, ids, other):
            self._known[w] = array("i", i).tobytes()
            # A lone marker is no text to the original library, but a piece inside one.
            if i != o and w != " ":
                self._unequal.add(w)
        # Decoding takes off the blank that stands for the marker of the first word.
        self._changed.update(w for w, d in zip(words, self.decode(ids)) if " " + d != w)


def encode(df: DataFrame, model_path: str, text: str = "text", threads: int | None = None) -> DataFrame:
    """Append ``token_ids``, ``n_tokens``, ``parity`` and ``round_trip`` for each whole text.

    ``parity``: the original library gives the same ids. ``round_trip``: decoding the ids gives
    the text back. All four are NULL for NULL texts. A batch is encoded by ``threads`` threads, as
    many as Spark gives a task (``spark.task.cpus``) if not set.
    """
    fields = [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("parity", T.BooleanType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    threads = threads or int(df.sparkSession.conf.get("spark.task.cpus", "1"))
    data = model_bytes(model_path)

    def start():
        codec = Codec(data, threads)

        def step(texts):
            values = texts.to_pylist()
            done = codec.encode(values)
            sizes = [0 if d is None else len(d[0]) for d in done]
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            flat = [d[0] for d in done if d is not None]
            flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            mask = pa.array([d is None for d in done], pa.bool_())
            ids = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=mask
            )
            return [
                ids,
                pa.array([None if d is None else len(d[0]) for d in done], pa.int64()),
                pa.array([None if d is None else d[1] for d in done], pa.bool_()),
                pa.array([None if d is None else d[2] for d in done], pa.bool_()),
            ]

        return step

    return append_columns(df, [text], fields, start)


def decode(df: DataFrame, model_path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """Append the text that ``ids`` decode to; NULL ids give NULL."""
    data = model_bytes(model_path)

    def start():
        codec = Codec(data)

        def step(lists):
            values = lists.to_pylist()
            back = codec.decode([v or [] for v in values])
            return [pa.array([None if v is None else d for v, d in zip(values, back)], pa.string())]

        return step

    return append_columns(df, [ids], [T.StructField(into, T.StringType())], start)
