"""Packing documents into windows by lexical retrieval.

A document's ids are cut into full windows, which need no company, and a rest. The rests are the entries of an inverted index
with BM25 weights over token ids; document frequencies are counted over all rests of the corpus, the index itself is cut into
shards of bounded size that tasks of their own build. In a shard a seed, the rest of the last cut or else the longest unused
entry, asks the index for its unused neighbours, which fill its window in the order of their scores; the last one is cut where
the window ends. So every window is full but a shard's last, which is cut into sequences of a power of two and has no padding.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chunklake.llm.common import in_small_batches, kept

#: The vocabulary file, a parameter of the operators, and the id that ends a document.
TOKENIZER, END = public_tokenizers.path("word_bpe_49k.json"), 2
WINDOW = 4096
#: Tokens of an index shard, about: what one task holds.
SHARD_TOKENS = 1 << 19
#: Pieces of words whose ids a worker remembers, before it begins anew.
REMEMBERED = 1 << 20
#: BM25: saturation of repeats, and the weight of the length.
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TOKENS = "doc_id long, row long, doc_tokens long, first_window long, window_crcs array<long>, rest binary, frequency binary"

#: Words of these characters are cut into pieces here: visible ones of ASCII, Latin-1 and Latin Extended-A, in which lower case
#: stays. The tokenizer itself reads all others, and the special tokens.
_LAST = 0x17F
_PLAIN = f"^[!-~\u00a1-{chr(_LAST)}]+$"
_LETTERS, _NUMBERS = ("".join(chr(c) for c in range(_LAST + 1) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
#: How the vocabulary file splits text before the merges, for those characters; a carriage return stands between words.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+|\r")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def byte_of_letter() -> dict[str, int]:
    """Fixed: how byte-level vocabularies write bytes."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


def merges(whole: Tokenizer) -> tiktoken.Encoding:
    """The same merges as ranks of bytes, which are faster to apply. A piece ends in a line feed, which no piece holds.

    Ids rise with the merges, and a vocabulary of trained merges makes each token in one way only (a test proves it of the file).
    """
    byte, ranks = byte_of_letter(), {}
    special = {t.content for t in whole.get_added_tokens_decoder().values()}
    for token, rank in whole.get_vocab(with_added_tokens=True).items():
        if token not in special:
            last = token.endswith("</w>") and token != "</w>"
            ranks[bytes(byte[c] for c in (token[:-4] if last else token)) + b"\n" * last] = rank
    return tiktoken.Encoding("pieces", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of those numbers one behind the other, and where each ends."""
    ends = np.cumsum(sizes[codes])
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(starts[codes] - (ends - sizes[codes]), sizes[codes])
    return flat[at], ends


def _laid_out(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
    return np.frombuffer(b"".join(parts), "<u2"), np.cumsum(sizes) - sizes, sizes


class Ids:
    """Ids of texts, as 16-bit numbers. Different words and pieces of a batch are read once, pieces met last are remembered."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.merges = merges(self.whole)
        self.pieces: dict[str, bytes] = {"\r": b""}

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each text ends. Null texts are empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        if not len(texts):
            return np.zeros(0, "<u2"), np.zeros(0, np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        space = _SPACE[data[offsets[0] : offsets[-1]]]
        # stretches of space or word, cut at the ends of texts too
        cut = np.zeros(len(space) + 1, bool)
        cut[1:-1] = space[1:] != space[:-1]
        cut[offsets - offsets[0]] = True
        cuts = np.flatnonzero(cut) + offsets[0]
        stretches = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(len(cuts) - 1, 0), [None, pa.py_buffer(cuts.astype(np.int64)), texts.buffers()[2]])
        word = ~space[cuts[:-1] - offsets[0]]
        coded = stretches.dictionary_encode()
        codes = coded.indices.to_numpy()[word] if len(stretches) else np.zeros(0, np.int64)
        found, ends = _gathered(*_laid_out(self._words(coded.dictionary)), codes)
        words_before = np.searchsorted(cuts[:-1][word], offsets[1:])
        return found, np.append(0, ends)[words_before]

    def _words(self, words: pa.Array) -> list[bytes]:
        """The ids of different words; stretches of space have none."""
        words = words.cast(pa.large_string())
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), pc.match_substring(words, "<|")).to_numpy(zero_copy_only=False)
        found = [b""] * len(words)
        if plain.any():
            chosen = words.filter(pa.array(plain)).cast(pa.string())
            one = pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), chosen)
            low = unicodedata.normalize("NFC", pc.binary_join(one, "\r")[0].as_py()).lower()
            every = _PIECES.findall(low)
            number = {piece: n for n, piece in enumerate(dict.fromkeys(every))}
            codes = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
            ids, ends = _gathered(*_laid_out(self._learned(list(number))), codes)
            between = np.flatnonzero(codes == number.get("\r", -1))
            stops, flat, begin = [*(2 * ends[between]).tolist(), 2 * len(ids)], ids.tobytes(), 0
            for n, stop in zip(np.flatnonzero(plain).tolist(), stops, strict=True):
                found[n] = flat[begin:stop]
                begin = stop
        for n in np.flatnonzero(~plain).tolist():
            # letters that may be composed, or lowered by what stands beside them
            found[n] = np.array(self.whole.encode(words[n].as_py(), add_special_tokens=False).ids, "<u2").tobytes()
        return found

    def _learned(self, pieces: list[str]) -> list[bytes]:
        if len(self.pieces) > REMEMBERED:
            self.pieces = {"\r": b""}
        new = [p for p in pieces if p not in self.pieces]
        if new:
            # a token that ends a piece ends in a line feed
            ids = np.array(self.merges.encode_ordinary("\n".join(new) + "\n"), "<u2")
            ends = (2 * (np.flatnonzero(self._last_tokens[ids]) + 1)).tolist()
            flat, begin = ids.tobytes(), 0
            for piece, end in zip(new, ends, strict=True):
                self.pieces[piece] = flat[begin:end]
                begin = end
        return [self.pieces[p] for p in pieces]

    @cached_property
    def _last_tokens(self) -> np.ndarray:
        last = np.zeros(1 << 16, bool)
        last[[rank for token, rank in self.whole.get_vocab().items() if token.endswith("</w>")]] = True
        return last


def ids_for(path: str) -> Ids:
    """The worker's own, kept from task to task."""
    shelf = sys.modules.setdefault("_remembered_ids", types.ModuleType("_remembered_ids"))
    if path not in shelf.__dict__:
        shelf.__dict__[path] = Ids(path)
    return shelf.__dict__[path]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenizer(path: str, window: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document its full windows' checksums and its rest; at the end, in how many rests of the task each id stands."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_for(path)
        frequency = np.zeros(1 << 16, np.int64)
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary(), pa.binary()]
        windows = 0
        for batch in batches:
            rows = []
            found, ends = ids.of(batch["text"])
            begin = 0
            for doc_id, row, stop in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), ends.tolist(), strict=True):
                tokens = np.append(found[begin:stop], np.uint16(end))
                begin = stop
                full = len(tokens) // window
                rest = tokens[full * window :]
                if len(rest):
                    held = np.zeros(1 << 16, bool)
                    held[rest] = True
                    frequency += held
                crcs = [checksum(tokens[k * window : (k + 1) * window]) for k in range(full)]
                rows.append((doc_id, row, len(tokens), windows, crcs, rest.tobytes(), None))
                windows += full
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)
        met = frequency.astype("<i8").tobytes() if frequency.any() else None
        if met:
            values = (None, None, None, None, None, None, met)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    return tokenize


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for counts in batch["frequency"].to_pylist():
            total += np.frombuffer(counts, "<i8")
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["token", "n"])


class Weights:
    """BM25 weights of the ids of an entry, by the corpus's statistics."""

    def __init__(self, frequency: np.ndarray, entries: int, tokens: int):
        self.rarity = np.log1p((entries - frequency + 0.5) / (frequency + 0.5))
        self.mean = max(tokens / max(entries, 1), 1.0)
        self.frequency = frequency

    def of(self, token: np.ndarray, times: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return self.rarity[token] * times * (K1 + 1) / (times + K1 * (1 - B + B * size / self.mean))


def _keyed(weights: Weights, window: int, shard_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each entry's key: the id of most weight among those that enough entries hold to fill a window; and its parts, so that none is large."""
    common = weights.frequency * weights.mean >= window
    parts = np.maximum(1, np.ceil(4 * weights.frequency * weights.mean / shard_tokens)).astype(np.int64)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for rest in batch["rest"].to_pylist():
                token, times = np.unique(np.frombuffer(rest, "<u2"), return_counts=True)
                weight = np.where(common[token], weights.of(token, times, len(rest) // 2), -1)
                keys.append(int(token[np.argmax(weight)]) if weight.max() >= 0 else -1)
            split = [int(parts[k]) if k >= 0 else 1 << 30 for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64()), pa.array(split, pa.int64())], [*batch.schema.names, "key", "parts"])

    return key


class Index:
    """The inverted index of a shard: per id the entries that hold it, with their weights."""

    def __init__(self, entries: list[np.ndarray], weights: Weights):
        sizes = np.array([len(e) for e in entries], np.int64)
        entry = np.repeat(np.arange(len(entries)), sizes)
        held, times = np.unique((entry << 16) | np.concatenate(entries), return_counts=True)
        entry, token = held >> 16, (held & 0xFFFF).astype(np.uint16)
        self.starts = np.append(0, np.cumsum(np.bincount(entry, minlength=len(entries))))
        self.tokens = token
        order = np.argsort(token, kind="stable")
        self.entry = entry[order]
        self.weight = weights.of(token, times, sizes[entry])[order]
        self.lists = np.append(0, np.cumsum(np.bincount(token, minlength=1 << 16)))
        self.size = len(entries)

    def scores(self, seed: int) -> np.ndarray:
        """The score of every entry for the ids of the seed."""
        terms = self.tokens[self.starts[seed] : self.starts[seed + 1]]
        spans = [slice(lo, hi) for lo, hi in zip(self.lists[terms].tolist(), self.lists[terms.astype(np.int64) + 1].tolist(), strict=True)]
        entry = np.concatenate([self.entry[s] for s in spans])
        return np.bincount(entry, np.concatenate([self.weight[s] for s in spans]), self.size)


def fill(entries: list[np.ndarray], weights: Weights, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (entry, begin, length): all full but the last."""
    index = Index(entries, weights)
    unused = np.ones(len(entries), bool)
    by_size = iter(sorted(range(len(entries)), key=lambda n: (-len(entries[n]), n)))
    windows: list[list[tuple[int, int, int]]] = []
    cut: tuple[int, int] | None = None
    while cut or unused.any():
        seed, begin = cut or (next(n for n in by_size if unused[n]), 0)
        cut = None
        unused[seed] = False
        pieces = [(seed, begin, len(entries[seed]) - begin)]
        room = window - pieces[0][2]
        if room and unused.any():
            left = np.flatnonzero(unused)
            ranked = left[np.argsort(-index.scores(seed)[left], kind="stable")]
            for n in ranked.tolist():
                unused[n] = False
                size = len(entries[n])
                pieces.append((n, 0, min(size, room)))
                if size > room:
                    cut = (n, room)
                room -= pieces[-1][2]
                if not room:
                    break
        windows.append(pieces)
    return windows


def _in_powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces in sequences whose lengths are powers of two, the longest first."""
    left, total = list(pieces), sum(p[2] for p in pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        sequence = []
        while room:
            entry, begin, length = left.pop(0)
            taken = min(length, room)
            sequence.append((entry, begin, taken))
            if taken < length:
                left.insert(0, (entry, begin + taken, length - taken))
            room -= taken
        yield sequence


def _packer(weights: Weights, window: int) -> Callable[[pa.Table], pa.Table]:
    def pack(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("doc_id", "ascending"), ("row", "ascending")])
        entries = [np.frombuffer(rest, "<u2") for rest in shard["rest"].to_pylist()]
        ids, sizes = shard["doc_id"].to_pylist(), shard["doc_tokens"].to_pylist()
        base = shard["shard"][0].as_py() << 24
        windows = fill(entries, weights, window)
        sequences = [*windows[:-1], *_in_powers(windows[-1])]
        rows = []
        for number, pieces in enumerate(sequences):
            offset = 0
            for n, begin, length in pieces:
                start = sizes[n] - len(entries[n]) + begin
                rows.append((ids[n], start, length, checksum(entries[n][begin : begin + length]), sizes[n], 2 * (base + number) + 1, offset))
                offset += length
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.table([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], names)

    return pack


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, end: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``.

    A document's ids are those of its whole text and ``end``; each lies in one piece. ``tokenizer`` names a vocabulary file
    that stands at one place on all machines, and ``window`` is a power of two. Odd sequence ids are windows of several
    documents, even ones hold a part of one. Texts are tokenized once, into the shared folder; only rests shorter than a window
    are shuffled, 16 bits an id. The driver gets the frequencies of the vocabulary's ids and three sums, nothing else.

    A null or empty text is the ``end`` alone; repeated rows are documents of their own; rows without doc_id are packed with a
    null one; an empty table gives no rows; more columns do not matter. Entries none of whose ids is held by enough others to
    fill a window are dealt out evenly; entries of a common key, copies too, are dealt to as many shards as they fill.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("a window is a power of two")
    in_small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text")
    tokens = kept(rows.mapInArrow(_tokenizer(tokenizer, window, end), _TOKENS).withColumn("task", F.spark_partition_id().cast("long")), "packing")
    counts = tokens.filter("frequency IS NOT NULL").select("frequency").mapInArrow(_summed, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequency = np.zeros(1 << 16, np.int64)
    for row in counts.collect():  # at most one row for each id of the vocabulary
        frequency[row["token"]] = row["n"]
    documents = tokens.filter("row IS NOT NULL")
    rests = documents.withColumn("size", F.expr("octet_length(rest) div 2")).filter("size > 0")
    entries, total = rests.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    weights = Weights(frequency, entries, total)

    one = F.lit(window).cast("long")
    full = documents.select("doc_id", "doc_tokens", "first_window", "task", F.posexplode("window_crcs").alias("n", "crc")).select(
        "doc_id",
        (F.col("n") * one).alias("start"),
        one.alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        (2 * (F.shiftleft("task", 31) + F.col("first_window") + F.col("n"))).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    shards = max(1, -(-total // shard_tokens))
    keyed = rests.select("doc_id", "row", "doc_tokens", "rest")
    keyed = keyed.mapInArrow(_keyed(weights, window, shard_tokens), "doc_id long, row long, doc_tokens long, rest binary, key long, parts long")
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = keyed.select(F.pmod(F.xxhash64("key", part), F.lit(shards)).alias("shard"), "doc_id", "row", "doc_tokens", "rest")
    return full.unionByName(dealt.groupBy("shard").applyInArrow(_packer(weights, window), PIECES))
