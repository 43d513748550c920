"""Token ids in files: an adaptive context-mixing range coder in independent, checksummed blocks.

Every block of up to ``BLOCK`` ids starts from an empty model.  The next id's probability mixes three predictions:

* order 2 and order 1: the id that last followed the two ids (the one id) before, as one
  point mass each; a point's weight are learned odds that predictions of its confidence are right;
* order 0: adaptive counts over octaves of an id's frequency rank, uniform inside an octave.  Ranks come from the
  file's dictionary, its distinct ids by falling frequency.

The masses are integers that lie side by side, the points first, so a range coder codes an id in one step and the decoder
finds it without a search: 64 bits, without carry, as a range that would straddle a word border is cut short of it.
Blocks do not depend on each other; therefore all blocks of a file are coded
in lockstep, one step for the t-th id of each of them, as vectors.

A file holds whole documents in ascending id order (header, document ids and lengths, dictionary, block table, words of the
blocks) and the CRC-32 of its index and of each block's ids.  Files are written by Spark's text writer as one record each, with the
record's end mark as last byte, so that they are committed like any other output of a task and a lost executor leaves none behind.

Null texts count as empty: a document of the end id alone.  Null document ids come first.  Rows with equal ids are
ordered by text; equal rows repeat.  Texts of any length are encoded whole; a file ends with the document that fills it.
An empty table gives no files and no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import RollingHash, lowered, map_arrow, shared_folder, steps, stored, table, word_spans

END_ID = 2
#: Ids of a block, and ids after which a file ends with its document.
BLOCK, FILE_IDS = 1024, 1 << 22
#: Blocks coded in lockstep.
LANES = 4096
#: Slots of each of the two context tables of a block, as a power of two.
SLOT_BITS = 9
#: Distinct pieces of text whose ids a worker remembers; beyond it the memory is emptied (results stay the same).
REMEMBERED = 3_000_000
#: Bytes of text whose pieces are looked up together.
TEXT_BYTES = 4 << 20
RANGE_PREFIX = 64
#: Fixed values of the file format: mark, version, end mark.
MAGIC, VERSION, TAIL = b"LTID", 1, b"\n"

# --- coder ---------------------------------------------------------------------------------------------------------

#: Octaves of ranks: rank 0; 1 and 2; 3 to 6; and so on.  Ids are below 65,536.
_OCTAVES = 17
_RANKS = 1 << 16
_OCTAVE = np.floor(np.log2(np.arange(1, _RANKS + 1))).astype(np.int64)
_WITHIN = np.arange(1, _RANKS + 1) - (1 << _OCTAVE)
#: Growth of an octave's count at an occurrence.
_GROWTH = 2
_SMALL = _OCTAVE.astype(np.int8)
_EDGES = np.arange(_OCTAVES + 1, dtype=np.int8)[:, None]
#: Odds of a prediction, by state, in units of 2**-16: log odds from -8 to 6 in steps of 1/64.  State 0 is an empty slot's: no odds, and they stay so.
_LOG = np.arange(-512, 385) / 64.0
_ODDS = np.concatenate([[0], np.round(np.exp(_LOG) * 65536)]).astype(np.int64)
_STEP = 20 / (1 + np.exp(-_LOG))
_STATES = np.arange(1, len(_ODDS))
_NEXT = np.concatenate([[0], np.maximum(np.round(_STATES - _STEP), 1), [0], np.minimum(np.round(_STATES + 20.5 - _STEP), len(_LOG))]).astype(np.int64)  # after a miss; after a hit
_WORD, _REST = np.uint64(32), np.uint64(0xFFFFFFFF)


class Mixer:
    """Models of ``lanes`` blocks of at most ``size`` ids over ``ranks`` different ones, in step."""

    def __init__(self, lanes: int, ranks: int, size: int):
        self.bits = int(_OCTAVE[max(ranks, 1) - 1])
        # both points together weigh less than 2**31, so that all masses fit into any range; a point weighs something
        least, most = (self.bits + 1) << self.bits, (self.bits + 1 + _GROWTH * size) << self.bits
        top = int(np.searchsorted(_ODDS, (1 << 30) / most * 65536, side="right")) - 1
        self.weight = np.maximum(_ODDS, -(-65536 // least))
        self.weight[0] = 0
        self.next = np.minimum(_NEXT, top)
        self.lane = np.arange(lanes)
        self.base = self.lane << SLOT_BITS
        self.slots = [self.base, self.base]
        # predicted rank, and from bit 17 whether there is none yet, the slot's last one failed, or it came true
        self.tables = [np.full(lanes << SLOT_BITS, _RANKS, np.int32) for _ in range(2)]
        self.odds = [np.tile(np.minimum(np.array([0, 257, 641, 0], np.int64), top), lanes) for _ in range(2)]
        self.cells = self.lane << 2
        # counts below each octave, one row an octave that some rank has
        self.below = np.repeat(np.arange(self.bits + 2, dtype=np.int32)[:, None], lanes, axis=1)
        self.count = self.bits + 1
        self.last = np.zeros(lanes, np.int64)

    def shrink(self, lanes: int) -> None:
        """Keep the first ``lanes`` blocks; the others have ended."""
        self.lane, self.cells, self.base, self.below, self.last = self.lane[:lanes], self.cells[:lanes], self.base[:lanes], self.below[:, :lanes].copy(), self.last[:lanes]
        self.slots = [s[:lanes] for s in self.slots]

    def points(self) -> list[tuple]:
        """(rank, place of the odds, their state, mass) of order 2 and of order 1."""
        out = []
        whole = self.count << self.bits
        for k in (0, 1):
            entry = self.tables[k].take(self.slots[k])
            at = self.cells + (entry >> 17)
            state = self.odds[k].take(at)
            mass = self.weight.take(state)
            mass *= whole
            mass >>= 16
            out.append((entry & 0x1FFFF, at, state, mass))
        return out

    def learn(self, x: np.ndarray, points: list[tuple], hits: list[np.ndarray]) -> None:
        for k, ((_, at, state, _), hit) in enumerate(zip(points, hits)):
            state = state + np.multiply(hit, len(_ODDS), dtype=np.int64)
            self.odds[k][at] = self.next.take(state)
            self.tables[k][self.slots[k]] = x + ((hit + np.int32(1)) << 17)
        grown = (_EDGES[: len(self.below)] > _SMALL.take(x)).view(np.int8)
        grown *= _GROWTH
        self.below += grown
        self.count += _GROWTH
        mask = (1 << SLOT_BITS) - 1
        near = x ^ (x >> SLOT_BITS)
        near &= mask
        near += self.base
        pair = x * 40503
        pair += self.last
        pair ^= pair >> 9
        pair &= mask
        pair += self.base
        self.slots = [pair, near]
        self.last = x * 30011


def _narrow(low: np.ndarray, span: np.ndarray, n: int) -> np.ndarray:
    """Lanes whose top word is to be shifted out; a range that straddles two top words is cut short of the border."""
    at = np.flatnonzero(span[:n] < (1 << 32))
    start, size = low[at], span[at]
    straddles = ((start ^ (start + size - np.uint64(1))) >> _WORD) != 0
    span[at] = np.where(straddles, (~start + np.uint64(1)) & _REST, size)
    return at


def _open(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Steps (t, blocks still open at t) for descending block sizes."""
    open_ = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    return enumerate(open_.tolist())


def _groups(sizes: np.ndarray) -> list[np.ndarray]:
    """Blocks in descending size, in equal groups of at most ``LANES``."""
    order = np.argsort(-sizes, kind="stable")
    return np.array_split(order, -(-len(order) // LANES)) if len(order) else []


def encode_blocks(ranks: np.ndarray, sizes: np.ndarray, distinct: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint32) of all blocks and how many each has; ``ranks`` are those of the blocks, of at most ``block`` each, one after the other."""
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out, count = [np.zeros(0, np.uint32)] * len(sizes), np.zeros(len(sizes), np.int64)
    for group in _groups(sizes):
        words, used = _encode_group(ranks, starts[group], sizes[group], distinct, block)
        for i, place in enumerate(group.tolist()):
            out[place] = words[i, : used[i]]
        count[group] = used
    return np.concatenate([np.zeros(0, np.uint32), *out]), count


def _encode_group(ranks: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distinct: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    lanes = len(sizes)
    mixer = Mixer(lanes, distinct, block)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words, used = np.empty((lanes, int(sizes[0]) + 2), np.uint32), np.zeros(lanes, np.int64)
    for t, n in _open(sizes):
        if n < len(mixer.lane):
            mixer.shrink(n)
        x = ranks.take(starts[:n] + t)
        points = mixer.points()
        (guess2, _, _, mass2), (guess1, _, _, mass1) = points
        hits = [guess2 == x, guess1 == x]
        both = mass2 + mass1
        octave = _OCTAVE.take(x)
        edge = octave * n + mixer.lane
        flat = mixer.below.reshape(-1)
        before, after = flat.take(edge), flat.take(edge + n)
        own = (after - before).astype(np.int64) << (mixer.bits - octave)
        start = both + (before.astype(np.int64) << mixer.bits) + own * _WITHIN.take(x)
        start = np.where(hits[0], 0, np.where(hits[1], mass2, start))
        own = np.where(hits[0], mass2, np.where(hits[1], mass1, own))
        part = span[:n] // (both + (mixer.count << mixer.bits)).view(np.uint64)
        low[:n] += part * start.view(np.uint64)
        span[:n] = part * own.view(np.uint64)
        at = _narrow(low, span, n)
        words[at, used[at]] = low[at] >> _WORD
        used[at] += 1
        low[at] <<= _WORD
        span[at] <<= _WORD
        mixer.learn(x, points, hits)
    words[np.arange(lanes), used] = low >> _WORD
    words[np.arange(lanes), used + 1] = low & _REST
    return words, used + 2


def decode_blocks(words: np.ndarray, counts: np.ndarray, sizes: np.ndarray, distinct: int, block: int = BLOCK) -> np.ndarray:
    """The ranks (uint16) of all blocks, one after the other."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    out = np.empty(starts[-1], np.uint16)
    words = np.append(words, np.zeros(2, np.uint32))  # a damaged block may ask for more
    for group in _groups(sizes):
        _decode_group(words, first[group], sizes[group], distinct, block, out, starts[group])
    return out


def _decode_group(words: np.ndarray, first: np.ndarray, sizes: np.ndarray, distinct: int, block: int, out: np.ndarray, starts: np.ndarray) -> None:
    lanes = len(sizes)
    mixer = Mixer(lanes, distinct, block)
    take = lambda at: words.take(at, mode="clip").astype(np.uint64)
    code, following = (take(first) << _WORD) | take(first + 1), first + 2
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    for t, n in _open(sizes):
        if n < len(mixer.lane):
            mixer.shrink(n)
        points = mixer.points()
        (guess2, _, _, mass2), (guess1, _, _, mass1) = points
        both = mass2 + mass1
        total = both + (mixer.count << mixer.bits)
        part = span[:n] // total.view(np.uint64)
        target = np.minimum(((code[:n] - low[:n]) // np.maximum(part, np.uint64(1))).view(np.int64), total - 1)
        by2 = target < mass2
        by1 = (target < both) ^ by2
        plain = np.maximum(target - both, 0)
        goal = (plain >> mixer.bits).astype(np.int32)
        octave = np.add.reduce((mixer.below[1:-1] <= goal).view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        edge = octave * n + mixer.lane
        flat = mixer.below.reshape(-1)
        before, after = flat.take(edge), flat.take(edge + n)
        own = (after - before).astype(np.int64) << (mixer.bits - octave)
        start = before.astype(np.int64) << mixer.bits
        within = (plain - start) // own
        x = np.where(by2, guess2, np.where(by1, guess1, (1 << octave) - 1 + within))
        np.minimum(x, _RANKS - 1, out=x)  # a damaged block may point beyond
        start = np.where(by2, 0, np.where(by1, mass2, both + start + own * within))
        own = np.where(by2, mass2, np.where(by1, mass1, own))
        low[:n] += part * start.view(np.uint64)
        span[:n] = part * own.view(np.uint64)
        at = _narrow(low, span, n)
        low[at] <<= _WORD
        span[at] <<= _WORD
        code[at] = (code[at] << _WORD) | take(following[at])
        following[at] += 1
        out[starts[:n] + t] = x
        mixer.learn(x, points, [guess2 == x, guess1 == x])


# --- ids of texts --------------------------------------------------------------------------------------------------

_SPLIT = np.zeros(256, bool)  # marks that end a piece after a letter
_SPLIT[[ord(c) for c in ".,;:!?"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True


def pieces(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of pieces that the tokenizer encodes alike alone and in place.

    They are words between white space; a run of punctuation after a letter at a word's end is a piece of its own.
    """
    starts, ends, row = word_spans(low, offsets)
    if not len(starts):
        return starts, ends, row
    marks = _SPLIT[low]
    # the end of the last byte at or before each place that is no mark
    body = np.where(marks, 0, np.arange(1, len(low) + 1))
    np.maximum.accumulate(body, out=body)
    cut = body[ends - 1]
    last, before = low[np.maximum(cut - 1, 0)], low[np.maximum(cut - 2, 0)]
    latin = (before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (cut - 2 >= starts)
    two = (cut < ends) & (cut > starts) & (_LETTER[last] | latin)
    place = np.arange(len(starts)) + np.cumsum(two) - two
    n = len(starts) + int(two.sum())
    out_starts, out_ends, out_row = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    out_starts[place], out_ends[place], out_row[place] = starts, np.where(two, cut, ends), row
    more = place[two] + 1
    out_starts[more], out_ends[more], out_row[more] = cut[two], ends[two], row[two]
    return out_starts, out_ends, out_row


class Encoder:
    """Ids of texts by the tokenizers library, each distinct piece once."""

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        if self.tokenizer.get_vocab_size() > _RANKS:
            raise ValueError("ids must be below 65,536")
        # a word that is one id, to stand between pieces that are encoded together
        self.between = next((w, i[0]) for w, i in self._words() if len(i) == 1)
        self.remembered = remembered
        self._forget()

    def _words(self):
        named = sorted(self.tokenizer.get_vocab().items(), key=lambda x: -x[1])
        for token, _ in named:
            word = token.removesuffix("</w>")
            if word.isascii() and word.isalpha() and len(word) > 3 and word != token:
                yield word, self.tokenizer.encode(word, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.hashes, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)

    def _encode_each(self, texts: list[str]) -> list[list[int]]:
        word, mark = self.between
        joined = f"\n{word}\n".join(texts)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        cuts = np.flatnonzero(ids == mark)
        if len(cuts) == len(texts) - 1:
            return [part[1:] if i else part for i, part in enumerate(np.split(ids, cuts))]
        # some piece holds the word between: each on its own
        return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        if len(self.hashes) > self.remembered:
            self._forget()
        parts = []
        for a in range(0, len(raw), 20_000):
            parts += self._encode_each([r.decode() for r in raw[a : a + 20_000]])
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = len(self.pool) + np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.pool = np.concatenate([self.pool, *parts]).astype(np.uint16)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.starts, self.sizes = (np.insert(old, at, new[order]) for old, new in ((self.hashes, hashes), (self.starts, starts), (self.sizes, sizes)))

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return at, (self.hashes[at] == hashes) if len(self.hashes) else np.zeros(len(hashes), bool)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint16) of all texts, each with ``END_ID`` at its end, and how many each has."""
        import pandas as pd

        low = lowered(data)
        starts, ends, row = pieces(low, offsets)
        n = len(offsets) - 1
        if not len(starts):
            return np.full(n, END_ID, np.uint16), np.ones(n, np.int64)
        code, distinct = pd.factorize(RollingHash(low).of(starts, ends))
        order = np.argsort(distinct)
        wanted = distinct[order]
        at, have = self._find(wanted)
        if not have.all():
            missing = order[~have]
            first = np.full(len(distinct), -1, np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            raw = low.tobytes()
            first = first[missing]
            if len(self.hashes) + len(missing) > self.remembered:  # room for all of this step
                self._forget()
                missing = order
                first = np.full(len(distinct), -1, np.int64)
                first[code[::-1]] = np.arange(len(code))[::-1]
                first = first[missing]
            self._learn(distinct[missing], [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            at, _ = self._find(wanted)
        place = np.empty(len(distinct), np.int64)
        place[order] = at
        place = place[code]
        sizes, begin = self.sizes[place], self.starts[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.arange(total[-1])
        out = np.full(total[-1] + n, END_ID, np.uint16)
        out[inside + np.repeat(row, sizes)] = self.pool[inside + np.repeat(begin - total[:-1], sizes)]
        return out, np.bincount(row, weights=sizes, minlength=n).astype(np.int64) + 1


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


# --- files ---------------------------------------------------------------------------------------------------------

_HEAD = np.dtype([*((n, "<i8") for n in ("partition", "number", "before", "documents", "ids", "distinct", "block", "blocks", "words", "index")), ("index_crc", "<u4")])


def file_bytes(partition: int, number: int, before: int, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One file; ``before``: ids of earlier files of the same partition."""
    often = np.bincount(ids, minlength=_RANKS)
    dictionary = np.argsort(-often, kind="stable")[: int((often > 0).sum())]
    rank = np.zeros(_RANKS, np.int64)
    rank[dictionary] = np.arange(len(dictionary))
    sizes = np.full(-(-len(ids) // block), block, np.int64)
    sizes[-1] = len(ids) - block * (len(sizes) - 1)
    words, used = encode_blocks(rank[ids], sizes, len(dictionary), block)
    checks = [zlib.crc32(ids[a : a + block].astype("<u2")) for a in range(0, len(ids), block)]
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    columns = [known.astype("u1"), doc_ids.fill_null(0).to_numpy().astype("<i8"), counts.astype("<i8"), dictionary.astype("<u2"), sizes.astype("<u4"), used.astype("<u4"), np.array(checks, "<u4")]
    index = zlib.compress(b"".join(c.tobytes() for c in columns))
    head = np.array([(partition, number, before, len(counts), len(ids), len(dictionary), block, len(sizes), len(words), len(index), 0)], _HEAD)
    head["index_crc"] = zlib.crc32(head.tobytes()[:-4] + index)  # of the header as well
    return b"".join([MAGIC, bytes([VERSION]), head.tobytes(), index, words.astype("<u4").tobytes(), TAIL])


def read_file(content: bytes) -> tuple[dict, list, np.ndarray, np.ndarray]:
    """Header, document ids, counts and ids (uint16) of one file; a damaged one raises ValueError."""
    start = len(MAGIC) + 1
    if content[: len(MAGIC)] != MAGIC or content[len(MAGIC)] != VERSION or content[-1:] != TAIL:
        raise ValueError("not a token file")
    head = {n: int(np.frombuffer(content, _HEAD, 1, start)[0][n]) for n in _HEAD.names}
    start += _HEAD.itemsize
    index = content[start : start + head["index"]]
    if zlib.crc32(content[len(MAGIC) + 1 : start - 4] + index) != head["index_crc"] or len(content) != start + head["index"] + 4 * head["words"] + len(TAIL):
        raise ValueError("damaged index of a token file")
    raw, at, columns = zlib.decompress(index), 0, []
    for kind, n in (("u1", "documents"), ("<i8", "documents"), ("<i8", "documents"), ("<u2", "distinct"), ("<u4", "blocks"), ("<u4", "blocks"), ("<u4", "blocks")):
        columns.append(np.frombuffer(raw, kind, head[n], at))
        at += columns[-1].nbytes
    known, doc_ids, counts, dictionary, sizes, used, checks = columns
    words = np.frombuffer(content, "<u4", head["words"], start + head["index"])
    ranks = decode_blocks(words, used.astype(np.int64), sizes.astype(np.int64), len(dictionary), head["block"])
    if len(ranks) and ranks.max() >= len(dictionary):
        raise ValueError("damaged block of a token file")
    ids = dictionary[ranks]
    at = 0
    for size, check in zip(sizes.tolist(), checks.tolist()):
        if zlib.crc32(ids[at : at + size].astype("<u2")) != check:
            raise ValueError("damaged block of a token file")
        at += size
    return head, [i if k else None for i, k in zip(doc_ids.tolist(), known.tolist())], counts, ids


def _grouped(batches, limit: int):
    """(document ids, data, offsets) of about ``limit`` bytes of text."""
    held, size = [], 0
    for rows, data, offsets in steps(batches, 1):
        held.append((rows.column(0), data.copy(), offsets))
        size += len(data)
        if size >= limit:
            yield _merged(held)
            held, size = [], 0
    if held:
        yield _merged(held)


def _merged(held: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    shift = np.concatenate([[0], np.cumsum([len(d) for _, d, _ in held])])
    offsets = np.concatenate([[0], *[o[1:] + s for (_, _, o), s in zip(held, shift)]])
    return pa.concat_arrays([i for i, _, _ in held]), np.concatenate([d for _, d, _ in held]), offsets


def write_files(docs: DataFrame, path: str, vocabulary: str, file_ids: int = FILE_IDS) -> None:
    """Files of ``docs`` (doc_id, text) below ``path``, in ascending id order; ``vocabulary`` is the tokenizer's JSON."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one file of a few MB
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id", F.substring("text", 1, RANGE_PREFIX)).sortWithinPartitions("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        partition, number, before = TaskContext.get().partitionId(), 0, 0
        own = encoder(shared.value)
        held: list[tuple] = []
        size = 0
        for doc_ids, data, offsets in _grouped(batches, TEXT_BYTES):
            ids, counts = own.ids(data, offsets)
            ends = np.cumsum(counts)
            row, at = 0, 0
            while row < len(counts):
                until = min(int(np.searchsorted(ends, at + file_ids - size)), len(counts) - 1) + 1
                held.append((doc_ids.slice(row, until - row), counts[row:until], ids[at : ends[until - 1]]))
                size += int(ends[until - 1]) - at
                row, at = until, int(ends[until - 1])
                if size >= file_ids:
                    yield _record(partition, number, before, held)
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield _record(partition, number, before, held)

    content = map_arrow(rows, run, "content binary").select(F.col("content").cast("string").alias("value"))
    content.write.option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def _record(partition: int, number: int, before: int, held: list) -> pa.RecordBatch:
    content = file_bytes(partition, number, before, pa.concat_arrays([d for d, _, _ in held]), np.concatenate([c for _, c, _ in held]), np.concatenate([i for _, _, i in held]))
    return pa.RecordBatch.from_arrays([pa.array([content[: -len(TAIL)]], pa.binary())], names=["content"])  # the writer adds the end mark


def _read(spark: SparkSession, path: str, column: str, kind: T.DataType, make) -> DataFrame:
    """(doc_id, partition, before, n_tokens, ``column``) of all documents in the files; ``before`` counts ids of the partition."""
    schema = T.StructType().add("doc_id", "long").add("partition", "long").add("before", "long").add("n_tokens", "long").add(column, kind)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                head, doc_ids, counts, ids = read_file(content.as_py())
                ends = np.cumsum(counts)
                columns = [pa.array(doc_ids, pa.int64()), pa.array(np.full(len(counts), head["partition"])), pa.array(head["before"] + ends - counts), pa.array(counts), make(ids, ends - counts, ends)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(spark.read.format("binaryFile").load(path).select("content"), run, schema)


def _placed(rows: DataFrame) -> DataFrame:
    """``start`` in place of ``partition`` and ``before``: one running sum over the partitions' totals, a row each."""
    rows = stored(rows, "token-rows")
    order = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("partition").agg(F.sum("n_tokens").alias("n")).select("partition", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return rows.join(bases, "partition").withColumn("start", F.col("base") + F.col("before")).drop("partition", "before", "base")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, start) of all documents in the files below ``path``."""

    def make(ids, begin, ends):
        return pa.ListArray.from_arrays(pa.array(np.append(begin, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int32)))

    return _placed(_read(spark, path, "ids", T.ArrayType(T.IntegerType()), make))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, start): CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def make(ids, begin, ends):
        wide = ids.astype("<u4")
        return pa.array([zlib.crc32(wide[a:b]) for a, b in zip(begin.tolist(), ends.tolist())], pa.int64())

    return _placed(_read(spark, path, "ids_crc32", T.LongType(), make))


def op12_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    with open(vocabulary or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        text = file.read()
    path = shared_folder(spark, "token-files")
    write_files(table(spark, sf_dir, "documents"), path, text)
    return read_checksums(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
