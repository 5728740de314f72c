"""Token ids of whole texts, with chunks that texts share encoded once.

Texts are cut where a rolling hash of the last 16 characters says so, hence passages that several
texts share have the same chunks. A first scan counts the digests of all chunks. A second one encodes,
in place, every run of chunks that occur nowhere else; of the shared chunks it hands on the text, which
is encoded once for the whole corpus and joined with its occurrences. The codes of a text's runs and
chunks are then put together, and the joins repaired by re-encoding until both sides agree, so the ids
are those of the whole text. A text without shared chunks never leaves its task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.chunk_codes import Coder, chunk_key, chunks_of
from fraudlake.llm.common import stash, table
from fraudlake.llm.decontaminate import bit_filter, passes
from fraudlake.llm.tokens import parts as text_lists

SEEN = 1 << 18  # digests of chunks whose text a task has handed on already
COUNTED = 1 << 20
RESULT = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
RESULT_SQL = "n_tokens long, ids_sha256 string, decoded_sha256 string"
WHOLE, OWN, SHARED, TEXT = range(4)


def chunk_counts(texts: DataFrame) -> DataFrame:
    """``(gram, more, n)``: the 128-bit digest of every chunk of ``text`` and its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for some in text_lists(batch.column("text")):
                for chunks in chunks_of(some):
                    found.update(map(chunk_key, chunks))
                if len(found) > COUNTED:
                    yield counted(found)
                    found.clear()
        yield counted(found)

    def counted(found: Counter) -> pa.RecordBatch:
        keys = list(found)
        columns = [[k[0] for k in keys], [k[1] for k in keys], list(found.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["gram", "more", "n"])

    counts = texts.select("text").mapInArrow(run, "gram long, more long, n long")
    return counts.groupBy("gram", "more").agg(F.sum("n").alias("n"))


def coded_pieces(rows: DataFrame, names: list[str], vocabulary: Broadcast, bits: Broadcast) -> DataFrame:
    """Per text either its result (kind WHOLE) or its pieces by number: the codes of an OWN run, or the
    digest of a SHARED chunk. Besides, the TEXT of shared chunks, about once for each task."""
    kept = [(n, rows.schema[n].dataType.simpleString()) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = Coder(vocabulary.value), set()
        for batch in batches:
            done = 0
            for some in text_lists(batch.column("text")):
                yield pieces(coder, seen, batch.slice(done, len(some)), some)
                done += len(some)

    def pieces(coder: Coder, seen: set, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        chunked = chunks_of(texts)
        keys = [chunk_key(c) for chunks in chunked for c in chunks]
        grams = np.array([k[0] for k in keys], np.int64).view(np.uint64)
        shared = passes(bits.value, grams).tolist()
        row, kind, pos, key, runs, of_run, said = [], [], [], [], [], [], []
        at = 0
        for number, chunks in enumerate(chunked):
            marked = shared[at : at + len(chunks)]
            if not any(marked):
                row.append(number), kind.append(WHOLE), pos.append(0), key.append((0, 0)), said.append(None)
                of_run.append(len(runs)), runs.append(texts[number])
                at += len(chunks)
                continue
            own: list[str] = []
            place = 0
            for chunk, is_shared in [*zip(chunks, marked), ("", True)]:
                if is_shared and own:
                    row.append(number), kind.append(OWN), pos.append(place), key.append((0, 0)), said.append(None)
                    of_run.append(len(runs)), runs.append("".join(own))
                    own, place = [], place + 1
                if not is_shared:
                    own.append(chunk)
                elif chunk:
                    if keys[at] not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(keys[at])
                        row.append(number), kind.append(TEXT), pos.append(0), key.append(keys[at]), said.append(chunk)
                        of_run.append(None)
                    row.append(number), kind.append(SHARED), pos.append(place), key.append(keys[at]), said.append(None)
                    of_run.append(None)
                    place += 1
                at += bool(chunk)
        codes = coder.encode(runs)
        results = [coder.result(codes[r]) if k == WHOLE else (None,) * 3 for k, r in zip(kind, of_run)]
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(n).take(pa.array(row, pa.int64())) for n in ["_row", *names]),
                pa.array(kind, pa.int32()),
                pa.array(pos, pa.int32()),
                pa.array([k[0] for k in key], pa.int64()),
                pa.array([k[1] for k in key], pa.int64()),
                pa.array([codes[r].tobytes() if k == OWN else None for k, r in zip(kind, of_run)], pa.binary()),
                pa.array(said, pa.string()),
                *(pa.array([r[i] for r in results], t) for i, (_, t) in enumerate(RESULT)),
            ],
            names=["_row", *names, "kind", "pos", "gram", "more", "codes", "said", *(n for n, _ in RESULT)],
        )

    schema = ["_row long", *(f"{n} {t}" for n, t in kept), "kind int, pos int, gram long, more long, codes binary, said string", RESULT_SQL]
    return rows.mapInArrow(run, ", ".join(schema))


def shared_codes(texts: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``(gram, more, codes)`` of chunk texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary.value)
        for batch in batches:
            done = 0
            for some in text_lists(batch.column("said")):
                part = batch.slice(done, len(some))
                done += len(some)
                codes = pa.array([c.tobytes() for c in coder.encode(some)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("gram"), part.column("more"), codes], names=["gram", "more", "codes"])

    return texts.mapInArrow(run, "gram long, more long, codes binary")


def put_together(pieces: DataFrame, names: list[str], vocabulary: Broadcast) -> DataFrame:
    """The result of every text from its pieces, which stand in order in one task."""
    kept = [(n, pieces.schema[n].dataType.simpleString()) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary.value)
        row, own, held, fields = None, (), [], []
        for batch in batches:
            fields = [*((n, batch.schema.field(n).type) for n in names), *RESULT]
            ended = []
            keeps = zip(*(batch.column(n).to_pylist() for n in names)) if names else ((),) * len(batch)
            for number, keep, codes in zip(batch.column("_row").to_pylist(), keeps, batch.column("codes")):
                if number != row:
                    if held:
                        ended.append((own, held))
                    row, own, held = number, keep, []
                held.append(np.frombuffer(codes.as_py(), np.uint32))
            yield packed(coder, ended, fields)
        if held:
            yield packed(coder, [(own, held)], fields)

    def packed(coder: Coder, ended: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
        codes = coder.joined([held for _, held in ended])
        out = [(*own, *coder.result(c)) for (own, _), c in zip(ended, codes)]
        columns = [pa.array([o[i] for o in out], kind) for i, (_, kind) in enumerate(fields)]
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    dealt = pieces.select("_row", *names, "pos", "codes").repartition("_row").sortWithinPartitions("_row", "pos")
    return dealt.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in kept), RESULT_SQL]))


def encoded(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row.

    ``vocabulary`` is the path of a plain byte-level BPE file in JSON (others are refused), read by
    the driver and broadcast; its size is that of the vocabulary. The ids are digested as
    little-endian unsigned 32-bit integers, the text that they decode to in UTF-8. Null and empty
    texts have no tokens. Special strings inside a text are one token each, none are added. Repeated
    rows stay repeated, and a row may repeat in any number: equal chunks are counted inside the tasks
    first. A text of any length is one row in one task; its chunks are spread like all others. Columns of
    any name may be kept. An empty table gives no rows.

    A bit filter (at most 2^28 bits, broadcast) says which chunks may occur twice. A chunk that it
    takes for shared by mistake is encoded and joined like a shared one, with the same result.
    """
    with open(vocabulary, encoding="utf-8") as file:
        config = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), *(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("text")
    )
    common = stash(chunk_counts(rows).where("n > 1").select("gram"))
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(common))
    found = stash(coded_pieces(rows, names, config, bits))
    texts = found.where(F.col("kind") == TEXT).groupBy("gram", "more").agg(F.min("said").alias("said"))
    codes = stash(shared_codes(texts, config))
    occurring = found.where(F.col("kind") == SHARED).select("_row", *names, "pos", "gram", "more")
    pieces = (
        occurring.join(codes, ["gram", "more"])
        .select("_row", *names, "pos", "codes")
        .unionByName(found.where(F.col("kind") == OWN).select("_row", *names, "pos", "codes"))
    )
    whole = found.where(F.col("kind") == WHOLE).select(*names, *(n for n, _ in RESULT))
    result = whole.unionByName(put_together(pieces, names, config))
    return result.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), *(n for n, _ in RESULT))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
