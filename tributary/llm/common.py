"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The code points of Unicode White_Space, as the tokenizer's pattern sees them.
WHITE = "\t-\r \x85\xa0  -     　"
#: Splits a text where the tokenizer's own pattern always splits too: before a space that starts a word, around white runs.
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Texts are worked on in groups of about so many characters.
GROUP_CHARS = 400_000
MASK = (1 << 64) - 1


def vocabulary(name: str) -> str:
    """Default place of a public vocabulary file; every operator also takes a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Digest of the text, and the id: names a row, null or repeated ids included; only rows equal in both share it."""
    return F.concat_ws(":", F.sha2(text_or_empty(text_column), 256), F.col(id_column).cast("long").cast("string"))


def map_rows(df: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, id_column: str = "doc_id") -> DataFrame:
    """mapInPandas in which ids pass as text, in and out: pandas would turn a column of longs with nulls into floats, and ids beyond
    2^53 into others. ``schema`` names the id as a long."""
    sent = df.withColumn(id_column, F.col(id_column).cast("long").cast("string"))
    out = sent.mapInPandas(work, schema.replace(f"{id_column} long", f"{id_column} string"))
    return out.withColumn(id_column, F.col(id_column).cast("long"))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that further ones can't clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def split_words(text: str | None) -> list[bytes]:
    """Words between the six ASCII white-space characters, unchanged."""
    return utf8(text).split()


class WordHashes(dict):
    """64-bit hashes of words, remembered for up to ``most`` words."""

    def __init__(self, most: int = 600_000, seed: int = 0):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word, seed=self.seed)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Keys that may be broadcast: those of at least this fraction of all rows, so at most as many.
HOT_MOST = 512


def join_by_key(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of left with right, which has one row per key and in ``count`` the number of left's rows with it.

    The at most HOT_MOST keys that hold 1 / HOT_MOST of all counted rows are broadcast, so that their rows stay where they
    are; only other keys' rows are shuffled. Both sides are read twice: written tables are best.
    """
    total = right.agg(F.sum(count).alias("total")).first()["total"] or 0
    is_hot = F.col(count) * HOT_MOST >= total
    hot = F.broadcast(right.where(is_hot).drop(count))
    cold = left.join(hot.select(*keys), keys, "left_anti").join(right.where(~is_hot).drop(count), keys)
    return left.join(hot, keys).unionByName(cold)


_held: dict[str, Callable[[], None]] = {}
_holder: list[str] = [""]


def give_back() -> None:
    """Give freed memory back to the system, which glibc else keeps."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def take_over(name: str, clear: Callable[[], None]) -> None:
    """Of what operators remember in a worker from task to task, only the last user's is held: others are cleared, and their
    memory is given back to the system."""
    if _holder[0] != name:
        _holder[0] = name
        _held[name] = clear
        for other, forget in _held.items():
            if other != name:
                forget()
        give_back()


_words = WordHashes()


def word_hashes() -> WordHashes:
    """This worker's word hashes."""
    take_over("words", _words.clear)
    return _words


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all windows of k values, by doubling; shorter input gives none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, width, done = None, 1, 0
    part = h
    power = base
    while True:
        if k & width:
            out = part[:n] if out is None else out * np.uint64(power) + part[done : done + n]
            done += width
        if width * 2 > k:
            break
        m = len(part) - width
        part = part[:m] * np.uint64(power) + part[width : width + m]
        power = power * power & MASK
        width *= 2
    return mix(out)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of each run, one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def groups(sizes: list[int], most: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Cut rows into consecutive ranges of about ``most`` characters."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class _Index(dict):
    """Numbers for chunks as they come; new ones wait in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = out = len(self)
        self.new.append(chunk)
        return out


class ChunkEncoder:
    """Encodes whole texts by remembered chunks, at most about ``most`` of them; ``encode_new`` encodes unseen ones.

    A plain text (single spaces and line feeds only) is cut by str.split. There a key that starts with a
    line feed is the chunk itself, one that starts with FIRST is the text's first chunk without the mark,
    and any other stands for a space and the key. Other texts are cut by CHUNK, their keys marked FIRST.
    """

    FIRST = "\x01"
    ODD = re.compile(f"[{FIRST}\x1c-\x1f{WHITE.replace(' ', '', 1)}]".replace("\t-\r", "\t\x0b-\r"))

    def __init__(self, most: int):
        self.most = most
        self.index = _Index()
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def _keep(self, n: int) -> None:
        """Forget all but the first n chunks: what was seen first is what is seen most."""
        kept = _Index()
        kept.update(islice(self.index.items(), n))
        self.index, self.used = kept, int(self.starts[n])

    def encode_new(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the keys' chunks in one array, and the number of each chunk's ids."""
        raise NotImplementedError

    def chunk(self, key: str) -> str:
        """The text that a key stands for."""
        return key[1:] if key[:1] == self.FIRST else key if key[:1] == "\n" else " " + key

    def _parts(self, text: str) -> list[str]:
        """Parts of an odd text that are encoded apart."""
        return [text]

    def _plain(self, text: str) -> bool:
        spaced = not any(x in text for x in ("  ", "\n\n", " \n", "\n ")) and text[0] not in " \n" and text[-1] not in " \n"
        return spaced and not self.ODD.search(text)

    def _keys(self, text: str) -> list[str]:
        if not text:
            return []
        if self._plain(text):
            return (self.FIRST + text.replace("\n", " \n")).split(" ")
        return [self.FIRST + c for part in self._parts(text) for c in CHUNK.findall(part)]

    def _learn(self) -> None:
        new = self.index.new
        first = len(self.index) - len(new)
        ids, lengths = self.encode_new(new)
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(need // 2 + len(ids), np.uint32)])
        if first + len(new) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(first // 2 + len(new), np.int64)])
            self.lengths = np.concatenate([self.lengths, np.zeros(first // 2 + len(new), np.int64)])
        self.ids[self.used : need] = ids
        self.starts[first : first + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(new)] = lengths
        self.used = need
        self.index.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array and the number of each text's ids."""
        if len(self.index) > self.most:
            self._keep(self.most * 3 // 4)
        found = [self._keys(x) for x in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        total = int(counts.sum())
        codes = np.fromiter(map(self.index.__getitem__, chain.from_iterable(found)), np.int64, total)
        if self.index.new:
            self._learn()
        lengths = self.lengths[codes]
        out = self.ids[gather(self.starts[codes], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edge = np.concatenate([[0], np.cumsum(counts)])
        return out, np.diff(ends[edge])


class LibraryEncoder(ChunkEncoder):
    """Ids by the tokenizers library, as its default settings give them for a whole text: the text of a special token is that token."""

    #: Chunks that the library gets in one string.
    RUN = 500

    def __init__(self, path: str, most: int = 500_000):
        super().__init__(most)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Bytes of each token: a byte-level vocabulary spells every byte as one character.
        self.sizes = np.zeros(max(*names.values(), *special) + 1 if special else max(names.values()) + 1, np.int64)
        self.sizes[list(names.values())] = [len(x) for x in names]
        for i, content in special.items():
            self.sizes[i] = len(content.encode())
        self.special = re.compile("|".join(f"({re.escape(x)})" for x in special.values())) if special else None

    def _parts(self, text: str) -> list[str]:
        # The library cuts at special tokens first, so that white space before one ends its part.
        return [x for x in self.special.split(text) if x] if self.special else [text]

    def encode_new(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_chunks([self.chunk(k) for k in keys], np.fromiter((k[:1] != self.FIRST for k in keys), bool, len(keys)))

    def encode_chunks(self, chunks: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Chunks of plain texts start where the pattern always splits: the library encodes them in long strings, and
        # the bytes of the tokens tell where each chunk ends. Others are encoded one by one.
        joined = [c for c, p in zip(chunks, plain) if p]
        runs = ["".join(joined[a : a + self.RUN]) for a in range(0, len(joined), self.RUN)]
        alone = [c for c, p in zip(chunks, plain) if not p]
        encode = self.tokenizer.encode_batch_fast
        ids = [np.array(x.ids, np.uint32) for x in encode(runs, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in joined), np.int64, len(joined)))
        edge = np.searchsorted(np.cumsum(self.sizes[ids]), ends, "left") + 1
        lengths = np.empty(len(chunks), np.int64)
        lengths[plain] = np.diff(edge, prepend=0)
        if not alone:
            return ids, lengths
        apart = [x.ids for x in encode(alone, add_special_tokens=False)]
        lengths[~plain] = [len(x) for x in apart]
        out = np.empty(int(lengths.sum()), np.uint32)
        starts = np.cumsum(lengths) - lengths
        out[gather(starts[plain], lengths[plain])] = ids
        out[gather(starts[~plain], lengths[~plain])] = np.fromiter(chain.from_iterable(apart), np.uint32)
        return out, lengths


class TableEncoder(LibraryEncoder):
    """The same ids. Chunks of plain texts are found all at once, in a table whose keys are the chunks' own bytes.

    A chunk of a plain text starts at the text's first byte, a space or a line feed. One of at most SHORT bytes is its own key:
    two 64-bit numbers, its size in the last byte. Longer ones, which are rare, are found by a dict, and other texts as by LibraryEncoder.
    """

    SHORT = 15
    #: For each size, the bytes of the two numbers that belong to the chunk, and the size in its place.
    LOW = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(SHORT + 1)], np.uint64)
    HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(SHORT + 1)], np.uint64)
    SIZE = np.arange(SHORT + 1, dtype=np.uint64) << np.uint64(56)
    #: First bytes of the characters that ODD finds.
    HINT = np.zeros(256, bool)
    HINT[[c.encode()[0] for c in map(chr, range(1 << 14)) if LibraryEncoder.ODD.match(c)]] = True

    def __init__(self, path: str, most: int = 2_000_000):
        super().__init__(path, most // 4)  # what other texts have
        self.table_most = most
        self._clear((most * 2 - 1).bit_length())
        self.table_ids = np.empty(1 << 16, np.uint32)
        self.places = np.zeros(1 << 14, np.int64)  # where each chunk's ids start, and the end

    def _clear(self, bits: int) -> None:
        self.bits = bits
        self.low, self.high = (np.zeros(1 << self.bits, np.uint64) for _ in range(2))
        self.code = np.full(1 << self.bits, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.kept = 0

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Codes of short chunks, -1 for unknown ones."""
        slot = self._slots(low, high)
        out = self.code.take(slot)
        there = self.high.take(slot)
        left = np.flatnonzero((there != high) | (self.low.take(slot) != low))
        slot = slot[left]
        while len(left):
            there = self.high.take(slot)
            hit = (there == high[left]) & (self.low.take(slot) == low[left])
            out[left[hit]] = self.code.take(slot[hit])
            out[left[there == 0]] = -1
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def _put(self, low: np.ndarray, high: np.ndarray, codes: np.ndarray) -> None:
        """Put chunks that differ and aren't known into the table."""
        slot = self._slots(low, high)
        while len(slot):
            free = self.code[slot] < 0
            self.code[slot[free]] = codes[free]  # of several, one stays
            mine = self.code[slot] == codes
            self.low[slot[mine]], self.high[slot[mine]] = low[mine], high[mine]
            low, high, codes, slot = low[~mine], high[~mine], codes[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)

    def _rebuild(self, n: int, bits: int) -> None:
        """A table of 2 ** bits slots with the first n chunks alone: what was seen first is what is seen most."""
        stay = (self.code >= 0) & (self.code < n)
        low, high, codes = self.low[stay], self.high[stay], self.code[stay]
        long = {k: c for k, c in self.long.items() if c < n}
        self._clear(bits)
        self.kept, self.long = n, long
        self._put(low, high, codes)

    def _add(self, chunks: list[bytes]) -> None:
        """Encode new chunks; their codes follow."""
        # A text's first chunk starts with neither a space nor a line feed.
        ids, lengths = self.encode_chunks([c.decode() for c in chunks], np.fromiter((c[0] in (32, 10) for c in chunks), bool, len(chunks)))
        used, n = int(self.places[self.kept]), self.kept + len(chunks)
        if used + len(ids) > len(self.table_ids):
            self.table_ids = np.concatenate([self.table_ids[:used], np.empty(used // 4 + len(ids), np.uint32)])
        if n + 1 > len(self.places):
            self.places = np.concatenate([self.places[: self.kept + 1], np.zeros(n // 4 + len(chunks), np.int64)])
        self.table_ids[used : used + len(ids)] = ids
        self.places[self.kept + 1 : n + 1] = used + np.cumsum(lengths)
        self.kept = n

    def _codes(self, raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The codes of all chunks."""
        is_long = sizes > self.SHORT
        size = np.where(is_long, 0, sizes)
        # At each byte, the number of the eight bytes from there.
        eight = np.ndarray(len(raw) + 9, "<u8", raw + bytes(16), strides=(1,))
        low = eight[starts] & self.LOW[size]
        high = eight[starts + 8] & self.HIGH[size] | self.SIZE[size]
        codes = self._find(low, high)
        if is_long.any():
            at = np.flatnonzero(is_long)
            codes[at] = [self.long.get(raw[a : a + n], -1) for a, n in zip(starts[at].tolist(), sizes[at].tolist())]
        new = np.flatnonzero(codes < 0)
        if len(new):
            numbers: dict[bytes, int] = {}
            before = self.kept
            found = [raw[a : a + n] for a, n in zip(starts[new].tolist(), sizes[new].tolist())]
            got = np.fromiter((numbers.setdefault(c, len(numbers)) for c in found), np.int32, len(found))
            self._add(list(numbers))
            codes[new] = before + got
            if self.kept * 4 > 3 << self.bits:  # a text of very many chunks
                self._rebuild(self.kept, (self.kept * 2 - 1).bit_length())
            first = np.full(len(numbers), -1)
            first[got] = new
            short = ~is_long[first]
            self._put(low[first[short]], high[first[short]], (before + np.flatnonzero(short)).astype(np.int32))
            self.long.update((c, before + i) for c, i in numbers.items() if len(c) > self.SHORT)
        return codes

    def _all_plain(self, texts: list[str], data: np.ndarray, white: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Which texts are plain: what ``_plain`` says, for all texts together. An empty text has no chunks, so it is plain."""
        out = np.ones(len(texts), bool)
        sizes = np.diff(begins)
        full = np.flatnonzero(sizes)
        out[full] = ~(white[begins[full]] | white[begins[full] + sizes[full] - 1])
        out[np.searchsorted(begins, np.flatnonzero(white[1:] & white[:-1]), "right") - 1] = False
        # Only texts with bytes that odd characters have are searched for them.
        for i in np.unique(np.searchsorted(begins, np.flatnonzero(self.HINT[data]), "right") - 1).tolist():
            if out[i] and self.ODD.search(texts[i]):
                out[i] = False
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.kept > self.table_most:
            self._rebuild(self.table_most * 3 // 4, (self.table_most * 2 - 1).bit_length())
        pieces = [x.encode() for x in texts]
        raw = b"".join(pieces)
        data = np.frombuffer(raw, np.uint8)
        white = (data == 32) | (data == 10)
        begins = np.cumsum([0, *map(len, pieces)])
        plain = self._all_plain(texts, data, white, begins)
        if not plain.all():
            counts = np.empty(len(texts), np.int64)
            others, counts[~plain] = super().encode([x for x, p in zip(texts, plain) if not p])
            ids, counts[plain] = self.encode([x for x, p in zip(texts, plain) if p])
            out = np.empty(int(counts.sum()), np.uint32)
            first = np.cumsum(counts) - counts
            out[gather(first[plain], counts[plain])] = ids
            out[gather(first[~plain], counts[~plain])] = others
            return out, counts
        white[begins[begins < len(data)]] = True
        starts = np.flatnonzero(white)
        codes = self._codes(raw, starts, np.diff(starts, append=len(data)))
        at = self.places.take(codes)
        lengths = self.places.take(codes + 1) - at
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.table_ids.take(gather(at, lengths)), np.diff(ends[np.searchsorted(starts, begins)])


_encoders: dict[tuple, LibraryEncoder] = {}


def library_encoder(path: str, kind: type[LibraryEncoder] = LibraryEncoder) -> LibraryEncoder:
    """One encoder for each worker, kind and vocabulary, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    take_over("ids", _encoders.clear)
    if (path, kind) not in _encoders:
        _encoders.clear()
        _encoders[path, kind] = kind(path)
    return _encoders[path, kind]


def packed(docs: DataFrame) -> DataFrame:
    """doc_id (never null) and the compressed text, to move less."""
    from tributary.session import ship

    ship(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3).compress
        for frame in text_batches(frames):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "packed": [press(utf8(x)) for x in frame["text"]]})

    return docs.select("doc_id", "text").mapInPandas(work, "doc_id long, packed binary")


def text_batches(frames: Iterator[pd.DataFrame], column: str = "text") -> Iterator[pd.DataFrame]:
    """The rows again, in frames of about GROUP_CHARS characters, null texts as empty ones."""
    for frame in frames:
        if not len(frame):
            continue
        frame = frame.assign(**{column: [x if isinstance(x, str) else "" for x in frame[column]]})
        for a, b in groups([len(x) for x in frame[column]]):
            yield frame.iloc[a:b]
