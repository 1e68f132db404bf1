"""Near duplicates: minima of many universal hash functions, banding, verification, connected components.

Each row is a document of its own, named by its id and its text: rows that share an id
may hold different texts. Rows with the same set of shingles are one class and go on
as its smallest row.
A band of four minima that two classes share makes them candidates. In each bucket
only the pairs with its hub are checked at first: the member whose buckets are the
fullest, which in a group of edited copies is the text they were made from. What
these links leave apart is compared across components, by signatures in
blocks; so no pair that shares a band and could be a new link goes unchecked, and
a group of copies never becomes all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_words, broadcast_if_small, hashed, map_texts, mixed, texts, unused
from ledgerline.llm.components import components
from ledgerline.sources.cuts import cut, kept_table

BANDS, BAND_ROWS = 24, 4
MINIMA = BANDS * BAND_ROWS
_DRAWN = np.random.default_rng(20_240_501).integers(0, 2**63, (2, MINIMA), dtype=np.uint64)
FACTOR, SHIFT = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]
#: Standard errors below the threshold at which a pair's signatures rule it out: once in 1e11 pairs at the threshold.
SLACK = 8.0
#: A block of a bucket holds about so many members, and about so many shingles, at most.
BLOCK, BLOCK_SHINGLES = 1_000, 1_000_000
WORDS_A_PASS = 200_000
EVEN_SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)


def row_name(doc_id: Column | None = None, text: Column | None = None) -> Column:
    """Binary name of a row that sorts as its id does: the id with its sign turned, then half a digest of the text."""
    doc_id, text = F.col("doc_id") if doc_id is None else doc_id, F.col("text") if text is None else text
    number = F.lpad(F.hex(doc_id.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.unhex(F.concat(number, F.substring(F.md5(text), 1, 16)))


def id_in(name: str) -> Column:
    """The id that :func:`row_name` put into the column ``name``."""
    unsigned = F.conv(F.hex(F.substring(F.col(name), 1, 8)), 16, 10).cast("decimal(20,0)")
    return (unsigned - F.lit(str(2**63)).cast("decimal(20,0)")).cast("long")


def shingles(batch: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; a text of fewer words has one, one without words none."""
    out: list[np.ndarray] = []
    waiting: list[list[bytes]] = []

    def flush() -> None:
        flat = hashed([w for words in waiting for w in words])
        at = 0
        for words in waiting:
            h, at = flat[at : at + len(words)], at + len(words)
            span = min(size, len(h))
            if not span:
                out.append(h)
                continue
            total = np.full(len(h) - span + 1, span, np.uint64) * EVEN_SPREAD
            for i in range(span):
                total = mixed(total + h[i : len(h) - span + 1 + i] * np.uint64(2 * i + 3))
            out.append(np.unique(total))
        waiting.clear()

    pending = 0
    for text in batch:
        waiting.append(ascii_words(text))
        pending += len(waiting[-1])
        if pending >= WORDS_A_PASS:
            flush()
            pending = 0
    flush()
    return out


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """Minima of ``FACTOR * x + SHIFT`` modulo 2**64, a part of the set at a time."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_set), 2_048):
        part = shingle_set[at : at + 2_048]
        least = np.minimum(least, (FACTOR[:, None] * part + SHIFT[:, None]).min(axis=1))
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket name for each band, different between bands."""
    parts = signatures.reshape(-1, BANDS, BAND_ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) * EVEN_SPREAD + np.zeros((len(parts), 1), np.uint64)
    for i in range(BAND_ROWS):
        keys = mixed(keys * np.uint64(5) + parts[:, :, i])
    return keys


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix).ravel()))


def signed(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``row``, size and digest of the shingle set, band keys and 32-bit minima of each row; empty sets have no digest."""

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        sets = shingles(batch, size)
        minima = np.array([signature(s) for s in sets], np.uint64).reshape(len(sets), MINIMA)
        return {
            "n_shingles": [len(s) for s in sets],
            "set_id": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
            "bands": _lists(band_keys(minima).view(np.int64)),
            "minima": _lists((minima >> np.uint64(32)).astype(np.uint32).view(np.int32)),
        }

    named = texts(docs).withColumn("row", row_name())
    return map_texts(named, per_batch, "n_shingles long, set_id binary, bands array<bigint>, minima array<int>")


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, row, blocks of the bucket, n members, weight of the member) of the buckets with company."""
    rows = reps.select("row", "n_shingles", F.explode("bands").alias("bucket"))
    size = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    full = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.ceil(size).cast("int").alias("blocks")).where("n > 1")
    members = cut(rows.drop("n_shingles").join(full, "bucket"))
    weight = members.groupBy("row").agg(F.sum("n").alias("weight"))
    return members.join(weight, "row")


def _with_hubs(members: DataFrame) -> DataFrame:
    """Pairs (a < b) of a bucket's hub and another member."""
    hub = members.groupBy("bucket").agg(F.min(F.struct((-F.col("weight")).alias("w"), "row")).alias("hub"))
    pairs = members.join(hub.select("bucket", F.col("hub.row").alias("hub")), "bucket").where("row != hub")
    return pairs.select(F.least("row", "hub").alias("a"), F.greatest("row", "hub").alias("b")).distinct()


def least_agreement(percent: int) -> float:
    """Share of equal minima below which a pair of ``percent`` similarity all but never falls."""
    p = percent / 100
    return p - SLACK * (p * (1 - p) / MINIMA) ** 0.5


def _agreeing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Verification by signatures: pairs whose minima agree often enough."""
    side = lambda n: reps.select(F.col("row").alias(n), F.col("minima").alias(f"m{n}"))
    same = F.aggregate(
        F.zip_with("ma", "mb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x
    )
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(same >= least_agreement(percent) * MINIMA)
    return near.select("a", "b")


def _sets(names: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, row, shingles`` of the rows named by ``names``."""
    wanted = broadcast_if_small(cut(names.distinct()))
    rows = texts(docs).withColumn("row", row_name()).join(wanted, "row").dropDuplicates(["row"])

    def sets_of(batch: list[str]) -> dict[str, list]:
        return {"shingles": [s.view(np.int64) for s in shingles(batch, size)]}

    return kept_table(map_texts(rows, sets_of, "shingles array<bigint>"))


def _linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs that ``100 * intersection >= percent * union`` holds for, on the full sets."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("row")), docs, size)
    side = lambda n: sets.select(F.col("row").alias(n), F.col("shingles").alias(f"s{n}"))

    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(batch.sa, batch.sb, strict=True)]
            sizes = batch.sa.map(len) + batch.sb.map(len)
            batch = batch.assign(common=common)
            yield batch.loc[100 * batch.common >= percent * (sizes - batch.common), ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(confirmed, "a binary, b binary")


def _left_apart(members: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components that the hubs missed, one for each member and other component it links with.

    Of two members of a bucket in different components one at least is outside the bucket's
    largest component. Those members, in blocks, meet all members, in blocks; a task
    holds two blocks. Signatures rule pairs out, full sets confirm the others, a pair
    in its first common band only.
    """
    rows = members.where("n > 2").join(labels, "row", "left")
    rows = rows.select("bucket", "row", "blocks", F.coalesce("component", "row").alias("component"))
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    main = sizes.groupBy("bucket").agg(
        F.min(F.struct((-F.col("k")).alias("k"), "component")).alias("main"), F.count("*").alias("parts")
    )
    open_ = cut(rows.join(main.where("parts > 1").select("bucket", F.col("main.component").alias("main")), "bucket"))
    known = reps.select("row", "bands", "minima").join(_sets(open_.select("row"), docs, size).select("row", "shingles"), "row")
    full = kept_table(open_.join(known, "row"))
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["bucket", "row", "component", "bands", "minima", "shingles"]
    outside = full.where("component != main").select(*columns, own.alias("i"), every.alias("j"))
    all_ = full.select(*columns, own.alias("j"), every.alias("i"))
    cells = ["bucket", "i", "j"]
    least = least_agreement(percent) * MINIMA

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[bytes, bytes]] = []
        if len(left) and len(right):
            minima, bands = np.stack(right.minima.tolist()), np.stack(right.bands.tolist())
            # Numbers in place of names, which numpy would take for text and strip of zeros at the end.
            codes, _ = pd.factorize(pd.concat([right.component, left.component], ignore_index=True))
            parts, of_left = codes[: len(right)], codes[len(right) :]
            names, sets, lengths = right.row.tolist(), right.shingles.tolist(), right.shingles.map(len).to_numpy()
            for row, part in zip(left.itertuples(), of_left, strict=True):
                near = (parts != part) & ((minima == row.minima).sum(1) >= least)
                first = (bands == row.bands).argmax(1)
                near = np.flatnonzero(near & (bands[np.arange(len(parts)), first] == row.bucket))
                if not len(near):
                    continue
                flat = np.concatenate([sets[k] for k in near])
                at = np.minimum(np.searchsorted(row.shingles, flat), len(row.shingles) - 1)
                ends = np.cumsum(lengths[near])
                common = np.add.reduceat((row.shingles[at] == flat).astype(np.int64), ends - lengths[near])
                near = near[100 * common >= percent * (lengths[near] + len(row.shingles) - common)]
                _, once = np.unique(parts[near], return_index=True)
                found += [(min(row.row, names[k]), max(row.row, names[k])) for k in near[once]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    both = outside.groupBy(*cells).cogroup(all_.groupBy(*cells))
    return both.applyInPandas(compare, "a binary, b binary").distinct()


def _marked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, row, n_shingles`` of every row, and ``component``: the smallest row that links lead to, itself included."""
    rows = kept_table(signed(docs, size))
    classes = rows.where("set_id is not null and row is not null").groupBy("set_id").agg(F.min("row").alias("row"))
    reps = rows.join(classes, ["set_id", "row"]).dropDuplicates(["row"]).select("row", "n_shingles", "bands", "minima")
    members = cut(_buckets(reps))
    pairs = cut(_agreeing(_with_hubs(members), reps, percent))
    links = cut(_linked(pairs, docs, size, percent))

    def labelled(links: DataFrame) -> DataFrame:
        return cut(components(links).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")))

    labels = labelled(links)
    more = cut(_left_apart(members, labels, reps, docs, size, percent))
    if not more.isEmpty():
        labels = labelled(links.unionAll(more))
    of_class = classes.join(labels, "row", "left").select("set_id", F.coalesce("component", "row").alias("component"))
    # Cut, so that both sides of the last join come straight from a shuffle and a class of very many copies can be split.
    of_class = cut(of_class)
    alone = F.unhex(F.concat(F.hex(F.lit("none")), F.lpad(F.hex("doc_id"), 16, "0")))
    keyed = rows.select("doc_id", "row", "n_shingles", F.coalesce("set_id", alone, F.lit(b"none")).alias("set_id"))
    component = F.when(F.col("row").isNotNull(), F.coalesce("component", "row"))
    return keyed.join(of_class, "set_id", "left").select("doc_id", "row", "n_shingles", component.alias("component"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Component of every row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Words are what white space of ASCII parts, A-Z lower-cased; shingles are ``size`` of
    them. Links join documents whose shingle sets overlap by ``percent`` or more
    of their union. A null text is empty; empty sets link with nothing. Repeated
    rows give the same row each; rows that share an id but not the text are documents of
    their own, each in the component of its text. A row with a null id can't be named in
    a link: its component is null and it is kept.
    """
    marked = _marked(docs, size, percent).select("doc_id", "n_shingles", id_in("component").alias("component_id"))
    return marked.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, but for near duplicates: the smallest row of each component stays, once.

    Rows are told apart by id and text, so another text under the same id stays too if it is
    no copy. Rows with a null id stay as they are.
    """
    marked = _marked(docs, size, percent).where("row is not null")
    names = marked.groupBy("row").agg(F.min(F.col("row") == F.col("component")).alias("kept"), F.count("*").alias("n"))
    own, place, name = unused(docs, "own_row"), unused(docs, "place"), unused(docs, "row_name")
    odd = cut(names.where("not kept or n > 1").select(F.col("row").alias(own), "kept"))
    named = texts_beside(docs, name)
    rest = named.join(broadcast_if_small(odd.select(own)), F.col(name) == F.col(own), "left_anti").drop(name)
    repeated = odd.where("kept").select(own)
    if repeated.isEmpty():
        return rest
    again = named.join(broadcast_if_small(repeated), F.col(name) == F.col(own), "left_semi")
    first = F.row_number().over(Window.partitionBy(name).orderBy(name))
    once = again.withColumn(place, first).where(F.col(place) == 1).select(*docs.columns)
    return rest.unionByName(once)


def texts_beside(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the name of each row as the column ``name``, from the id and text that :func:`texts` reads."""
    number, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(name, row_name(number, text))
