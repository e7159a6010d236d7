"""Alignment of two tokenizers over a corpus, with inverted pair bitmaps.

1. *Tokens.* Each text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B). Both always
   cut before a blank that stands between two other characters, so a text is a row of stretches that
   begin with such a blank, and each different stretch is encoded and aligned once a block: a block of texts
   is a list of stretch numbers. ``test_stretches_against_whole_texts`` holds this against whole texts.
2. *Links.* An A and a B token whose byte ranges overlap are linked; byte offsets where both
   end cut the text into groups.
3. *Inverted index.* Documents are numbered within blocks of bounded size. For each pair of ids a
   block has the bitmap of the documents that hold the pair, and, for documents that hold it ``m`` times,
   a plane for each binary digit of ``m - 1``. A container is a sorted list of 16-bit numbers
   or, beyond a sixteenth of the block, plain bits.
4. *Counts.* Containers of different blocks share no document, so their union is the list
   of them and its size the sum of their sizes; links are the documents and the planes'
   sizes at their weights. Each container counts itself before the shuffle, which so carries a
   few numbers for each pair and block.
5. *Postings return scores.* Each container takes its pair's score back to the documents of its
   block, which are summed there.

Defined results: NULL and empty texts, and texts that one of the tokenizers doesn't give back byte
for byte, have no tokens: zeros and an empty string; repeated rows are documents of their own and
count each time; a row whose id is NULL takes part; other columns are ignored; no documents
give no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.rows import named
from salestide.session import stored

FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block ends when it has so many links or documents, with the part that brings it there.
BLOCK_LINKS, BLOCK_DOCS = 2_000_000, 1 << 16
#: Different stretches that a worker keeps from one block to the next.
KEPT = 300_000
#: Texts that are worked through at once.
PART = 128
#: Bytes that are encoded at once.
CHUNK = 1 << 16
#: An id of B is below this; a pair is ``a * SECOND + b``.
SECOND = 1 << 24
#: Where a text may be cut: before a blank that follows none and is followed by no white space.
CUT = re.compile(r"(?<=[^ ])(?= \S)")
#: Fixed value: the pattern by which a byte-level vocabulary of this kind cuts texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters up to here are classed alike by all versions of Unicode in use.
SETTLED = re.compile("[^\0-\u04ff\u2010-\u2027]")
#: The plane of the documents that hold a pair at all.
ALL = -1


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, and the number of bytes of each of their ids."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = {k: bytes(letters[c] for c in t) for t, k in vocabulary.items() if all(c in letters for c in t)}
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.size_a = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for k, data in self.bytes_a.items():
            self.size_a[k] = len(data)
        self.size_b = np.array([len(data) for data in self.bytes_b])

        ranks = {data: k for k, data in self.bytes_a.items()}
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a blank and the text; None if the bytes aren't the same.

        Of two libraries with the same vocabulary the quicker one reads what both class alike.
        """
        if SETTLED.search(text):
            ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        else:
            ids_a = self.fast.encode_ordinary(" " + text)
        ids_b = self.b.encode(text, num_threads=1)
        want = (" " + text).encode()
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != want:
            return None
        if b"".join(map(self.bytes_a.get, ids_a, repeat(b""))) != want:
            return None
        return ids_a, ids_b


class Places(dict):
    """Stretches and their numbers; a new one gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        k = self[text] = len(self)
        self.new.append(text)
        return k


class Stretches:
    """The different stretches met so far: counts, the groups as text, and links of each.

    A stretch is kept without its leading blank.
    """

    def __init__(self, tokenizers: Pair):
        self.pair = tokenizers
        self.names_a = [str(k) for k in range(len(tokenizers.size_a))]
        self.names_b = [str(k) for k in range(len(tokenizers.size_b))]
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.bad: set[int] = set()
        self.said: list[str] = []
        # Rows of n_a, n_b, n_groups, n_links and whether both tokenizers give the bytes back.
        self.facts: list[np.ndarray] = [np.zeros((0, 5), np.int64)]
        self.links: list[np.ndarray] = [np.zeros(0, np.int64)]

    def rows(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's stretches; new ones are encoded."""
        cuts = [text.split(" ") if text else [] for text in texts]
        known = len(self.place)
        found = [np.fromiter(map(self.place.__getitem__, cut), np.int64, len(cut)) for cut in cuts]
        # A piece without text, or with white space ahead, isn't one: such texts are cut with care.
        bad = [k for k, text in enumerate(self.place.new, known) if not text or text[0].isspace()]
        self.bad.update(bad)
        if self.bad:
            wrong = np.fromiter(self.bad, np.int64)
            for k, rows in enumerate(found):
                if np.isin(rows, wrong).any():
                    cut = [one[1:] for one in CUT.split(" " + texts[k])]
                    found[k] = np.fromiter(map(self.place.__getitem__, cut), np.int64, len(cut))
        new, self.place.new = self.place.new, []
        self._add(new)
        return found

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """Facts and links of all stretches."""
        self.facts, self.links = [np.concatenate(self.facts)], [np.concatenate(self.links)]
        return self.facts[0], self.links[0]

    def _add(self, wanted: list[str]) -> None:
        easy: list[str] = []
        size = 0
        for text in wanted:
            alone = not text or " " in text or text[0].isspace()
            if easy and (alone or size > CHUNK):
                self._encode(easy)
                easy, size = [], 0
            if alone:
                self._encode([text])
            else:
                easy.append(text)
                size += len(text) + 1
        if easy:
            self._encode(easy)

    def _encode(self, texts: list[str]) -> None:
        """Encode stretches side by side; one by one if their ends aren't ends of tokens."""
        found = self.pair.encode(" ".join(texts))
        if found:
            ids_a, ids_b = (np.array(ids, np.int64) for ids in found)
            ends_a, ends_b = np.cumsum(self.pair.size_a[ids_a]), np.cumsum(self.pair.size_b[ids_b])
            ends = np.cumsum([len(text.encode()) + 1 for text in texts])
            both = np.intersect1d(ends_a, ends_b, assume_unique=True)
            if np.isin(ends, both).all():
                self._align(ids_a, ids_b, ends_a, ends_b, both, ends)
                return
        if len(texts) > 1:
            for text in texts:
                self._encode([text])
            return
        self._keep([""], np.zeros((1, 5), np.int64), np.zeros(0, np.int64))

    def _keep(self, said: list[str], facts: np.ndarray, links: np.ndarray) -> None:
        self.said += said
        self.facts.append(facts)
        self.links.append(links)

    def _align(self, ids_a, ids_b, ends_a, ends_b, both, ends) -> None:
        starts_a, starts_b = ends_a - self.pair.size_a[ids_a], ends_b - self.pair.size_b[ids_b]
        first = np.searchsorted(ends_b, starts_a, "right")
        count = np.searchsorted(starts_b, ends_a, "left") - first
        at = np.repeat(np.arange(len(ids_a)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        links = ids_a[at] * SECOND + ids_b[first[at] + step]

        # All ids in order of their groups, A before B, each with the sign that follows it.
        group = np.r_[np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)]
        side = np.r_[np.zeros(len(ids_a), np.int64), np.ones(len(ids_b), np.int64)]
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        last = np.zeros(len(both), bool)
        last[np.searchsorted(both, ends)] = True
        sign = np.where(group[1:] == group[:-1], np.where(side[1:] == side[:-1], 0, 1), np.where(last[group[:-1]], 3, 2))
        signs = [",", "|", ";", "\n"]
        a, b = self.names_a, self.names_b
        names = [a[k] for k in ids_a.tolist()] + [b[k] for k in ids_b.tolist()]
        parts = [names[k] + signs[s] for k, s in zip(order.tolist(), [*sign.tolist(), 3])]
        said = "".join(parts).split("\n")[:-1]

        def each(places: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(np.searchsorted(ends, places), weight, len(ends)).astype(np.int64)

        facts = [each(ends_a), each(ends_b), each(both), each(ends_a, count), np.ones(len(ends), np.int64)]
        self._keep(said, np.stack(facts, axis=1), links)


_stretches: dict[tuple[str, str], Stretches] = {}


class Block:
    """Documents of a block: their ids, rows of stretch numbers, and facts."""

    def __init__(self, number: int, kind: pa.DataType):
        self.number, self.kind = number, kind
        self.ids: list[pa.Array] = []
        self.rows: list[np.ndarray] = []
        self.facts: list[tuple] = []
        self.links = 0

    def add(self, id: pa.Array, rows: np.ndarray, facts: np.ndarray, store: Stretches) -> None:
        own = np.zeros(5, np.int64)
        if len(rows):
            own = facts[rows].sum(axis=0)
        if own[4] < max(1, len(rows)):
            rows, own, said = rows[:0], np.zeros(5, np.int64), ""
        else:
            groups = ";".join(map(store.said.__getitem__, rows.tolist()))
            said = hashlib.sha256(groups.encode()).hexdigest()
        self.ids.append(id)
        self.rows.append(rows)
        self.facts.append((*own[:4].tolist(), said))
        self.links += int(own[3])

    def full(self, most: int) -> bool:
        return self.links >= most or len(self.rows) > BLOCK_DOCS - PART


def containers(pairs: np.ndarray, docs: np.ndarray, size: int) -> tuple[np.ndarray, list[bytes] | pa.Array, np.ndarray]:
    """Each different pair of the sorted rows, its container, and whether that is plain bits."""
    begin = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
    ends = np.r_[begin, len(pairs)]
    dense = np.diff(ends) > max(8, size // 16)
    data = docs.astype("<u2").tobytes()
    listed = [data[2 * s : 2 * e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
    for k in np.flatnonzero(dense):
        bits = np.zeros(size, bool)
        bits[docs[ends[k] : ends[k + 1]]] = True
        listed[k] = np.packbits(bits, bitorder="little").tobytes()
    return pairs[begin], listed, dense


def members(bits: bytes, dense: bool) -> np.ndarray:
    """The documents of a container, in order."""
    if not dense:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


NAMES = ["block", "pair", "plane", "dense", "bits", "id", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _schema(kind: str) -> str:
    return (
        f"block long, pair long, plane int, dense boolean, bits binary, id {kind}, place int, "
        "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    )


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(count)
    return np.repeat(begin - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


def _inverted(block: Block, store: Stretches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pair, document, times``, sorted by the first two."""
    facts, links = store.compact()
    begin = np.cumsum(facts[:, 3]) - facts[:, 3]
    row = np.repeat(np.arange(len(block.rows)), [len(one) for one in block.rows])
    used, stretch = np.unique(np.concatenate(block.rows), return_inverse=True)
    keys, times = np.unique(row * max(1, len(used)) + stretch, return_counts=True)
    row, stretch = np.divmod(keys, max(1, len(used)))
    own = facts[used, 3]
    found, pair = np.unique(links[_ranges(begin[used], own)], return_inverse=True)
    count = own[stretch]
    keys = pair[_ranges((np.cumsum(own) - own)[stretch], count)] * BLOCK_DOCS + np.repeat(row, count)
    times = np.repeat(times, count)
    bits = int(times.max(initial=0)).bit_length()
    if int(len(found) * BLOCK_DOCS).bit_length() + bits < 64:
        both = np.sort((keys << bits) | times)
        keys, times = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    if not len(keys):
        return keys, keys, times
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    pair, doc = np.divmod(keys[first], BLOCK_DOCS)
    return found[pair], doc, np.add.reduceat(times, first)


def _postings(block: Block, store: Stretches) -> Iterator[pa.RecordBatch]:
    """Rows of a block's documents, then those of its containers."""
    pair, doc, times = _inverted(block, store)
    more, size = times - 1, len(block.rows)

    *numbers, said = zip(*block.facts)
    arrays = [
        pa.array(np.full(size, block.number)), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32()),
        pa.nulls(size, pa.bool_()), pa.nulls(size, pa.binary()), pa.concat_arrays(block.ids),
        pa.array(np.arange(size), pa.int32()), *[pa.array(column, pa.int64()) for column in numbers],
        pa.array(said, pa.string()),
    ]
    yield pa.RecordBatch.from_arrays(arrays, NAMES)
    plane = ALL
    while len(pair):
        held = slice(None) if plane == ALL else (more >> plane) & 1 == 1
        pairs, bits, dense = containers(pair[held], doc[held], size)
        if len(pairs):
            count = len(pairs)
            arrays = [
                pa.array(np.full(count, block.number)), pa.array(pairs), pa.array(np.full(count, plane, np.int32)),
                pa.array(dense), pa.array(bits, pa.binary()), pa.nulls(count, block.kind), pa.nulls(count, pa.int32()),
                *[pa.nulls(count, pa.int64())] * 4, pa.nulls(count, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, NAMES)
        plane += 1
        if not (more >> plane).any():
            break


def _index(files: tuple[str, str], block_links: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _stretches.get(files)
        if store is None:
            store = _stretches[files] = Stretches(Pair(*files))
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        block = None
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id")
            block = block or Block(number, ids.type)
            for at in range(0, len(texts), PART):
                if len(store.said) > KEPT and not block.rows:
                    store.clear()
                found = store.rows(texts[at : at + PART])
                facts, _ = store.compact()
                for k, rows in enumerate(found, at):
                    block.add(ids.slice(k, 1), rows, facts, store)
                if block.full(block_links):
                    yield from _postings(block, store)
                    number += 1
                    block = Block(number, ids.type)
        if block and block.rows:
            yield from _postings(block, store)

    return index


def index(docs: DataFrame, files: tuple[str, str], id: str = "doc_id", text: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """The inverted index: a row for each document and for each container of a block."""
    own = named(docs, id=id, text=text)
    kind = own.schema["id"].dataType.simpleString()
    return stored(own.mapInArrow(_index(files, block_links), _schema(kind)), "pair-bitmaps")


def _held() -> Column:
    """How many documents a container holds."""
    listed = F.octet_length("bits") / 2
    return F.when(F.col("dense"), F.expr("bitmap_count(bits)")).otherwise(listed).cast("long")


def pair_counts(postings: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links, best`` of every pair; best: no pair of its B id has more links."""
    sizes = postings.filter("pair is not null").select("pair", "plane", _held().alias("held"))
    weight = F.when(F.col("plane") == ALL, F.col("held")).otherwise(F.expr("held * shiftleft(1L, plane)"))
    counts = sizes.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == ALL, F.col("held"))).alias("n_docs"), F.sum(weight).alias("n_links")
    )
    counts = stored(counts.withColumn("b", F.expr(f"pair % {SECOND}L")), "pair-counts")
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("n_links").alias("most"))
    joined = counts.join(most, F.col("b") == F.col("_b"))
    return joined.select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


RESULT = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Returned:
    """What a block's rows give: documents, containers and the scores of their pairs."""

    def __init__(self) -> None:
        self.docs: list[pa.RecordBatch] = []
        self.containers: list[pa.RecordBatch] = []
        self.scores: list[pa.RecordBatch] = []

    def add(self, part: pa.RecordBatch) -> None:
        pair, count = part.column("pair"), part.column("count")
        whole = pc.and_(pc.is_valid(pair), pc.is_null(count))
        for rows, held in ((self.docs, pc.is_null(pair)), (self.containers, whole), (self.scores, pc.is_valid(count))):
            own = part.filter(held)
            if len(own):
                rows.append(own)

    def made(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        size = 1 + max(pc.max(rows.column("place")).as_py() for rows in self.docs)
        sums = np.zeros((2, size), np.int64)
        if self.scores:
            pair, count, best = (
                np.concatenate([rows.column(name).to_numpy(zero_copy_only=False) for rows in self.scores])
                for name in ("pair", "count", "best")
            )
            order = np.argsort(pair)
            for part in self.containers:
                at = order[np.searchsorted(pair, part.column("pair").to_numpy(), sorter=order)]
                _add(part, count[at].astype(np.int64), best[at].astype(np.int64), sums)
        for rows in self.docs:
            at = rows.column("place").to_numpy()
            more = {"count_sum": pa.array(sums[0][at]), "n_best": pa.array(sums[1][at])}
            arrays = [more[c] if c in more else rows.column(c) for c in RESULT]
            yield pa.RecordBatch.from_arrays(arrays, RESULT)


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; within a block they are in any order."""
    number, own = None, Returned()
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            if start == end:
                continue
            if blocks[start] != number:
                yield from own.made()
                number, own = blocks[start], Returned()
            own.add(batch.slice(start, end - start))
    yield from own.made()


def _add(part: pa.RecordBatch, count: np.ndarray, best: np.ndarray, sums: np.ndarray) -> None:
    """Add the scores of containers to their documents, lists all at once."""
    dense = part.column("dense").to_numpy(zero_copy_only=False).astype(bool)
    plane = part.column("plane").to_numpy()
    times = np.where(plane == ALL, 1, np.int64(1) << np.maximum(plane, 0).astype(np.int64))
    bits = part.column("bits").to_pylist()
    listed = np.flatnonzero(~dense)
    if len(listed):
        docs = np.frombuffer(b"".join(bits[k] for k in listed), "<u2")
        held = np.array([len(bits[k]) // 2 for k in listed])
        for score, total in zip((count, best), sums):
            np.add.at(total, docs, np.repeat((score * times)[listed], held))
    for k in np.flatnonzero(dense):
        docs = members(bits[k], True)
        sums[0][docs] += (count * times)[k]
        sums[1][docs] += (best * times)[k]


def align(
    docs: DataFrame,
    files: tuple[str, str] = (f"{FOLDER}/{BYTE_FILE}", f"{FOLDER}/{PIECE_FILE}"),
    id: str = "doc_id",
    text: str = "text",
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """A row for each document, with the columns of ``RESULT``."""
    return scores(index(docs, files, id, text, block_links))


def scores(postings: DataFrame) -> DataFrame:
    """What the postings return to the documents."""
    kind = postings.schema["id"].dataType.simpleString()
    counts = pair_counts(postings).select(F.col("pair").alias("_pair"), F.col("n_links").alias("count"), "best")
    # The pairs of a block fetch their scores without the bitmaps, which move once, to their block.
    held = postings.filter(F.col("plane") == ALL).select("block", "pair")
    scored = held.join(counts, F.col("pair") == F.col("_pair")).drop("_pair")
    whole = postings.unionByName(scored, allowMissingColumns=True)
    whole = whole.repartition("block").sortWithinPartitions("block")
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return whole.mapInArrow(_returned, schema)
