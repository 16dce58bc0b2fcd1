"""Near duplicates: an exact self-join on the Jaccard similarity of word shingles.

Two documents whose similarity reaches the threshold share a token (shingle)
in their prefixes under *every* global token order, a set of ``s`` tokens
having the prefix of its first ``s - ceil(t * s) + 1``.  So candidates must
share prefix tokens under ``ORDERS`` different orders, and the intersection of
these filters is taken before a pair is verified.  All orders put tokens of one
document first (they make up most of an ordinary document's prefix but match
nothing) and tokens by ascending document frequency after them; they differ in
the permutation within a frequency.

1. Equal sets become one class, by a 128-bit signature; one document stands
   for it from here on.
2. Blocks of documents ask which tokens of a hash sample (``SAMPLE`` of all
   tokens, first in every order) occur in a second class.  A document whose
   sampled tokens of its own alone fill its prefix has no partner.
3. Among the survivors the exact frequency of every token is asked for, and
   each one's tokens that another survivor holds, and its prefixes, are
   written down.
4. Every token of the first order's prefixes names a *pivot*: its document
   with the smallest share of own tokens.  All documents of the token are
   verified against the pivot, and linked documents are joined to components.
5. Only pairs of a pivot's family that are not in one component yet remain:
   documents outside of the pivot's component against all others of the
   family.  A large family is dealt into a grid of cells by its rows and tokens,
   and a cell emits links only, never its pairs.

No link between different sets is lost and no pairs of a group are emitted.

Cases: a null text and one without words have an empty set, linked with
nothing; texts of fewer words than a shingle are one shingle; repeated rows
are linked if they have words; a null ``doc_id`` is never a component's id
unless all its members' are null; empty tables give no rows; further columns
are kept by :func:`keep_one_of_each` and ignored by the digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.llm import blocks as B
from adevents.llm.common import as_table, saved, spare_name, with_row_id
from adevents.llm.graph import components
from adevents.llm.substring_dedup import reply_shared, shared_bits
from adevents.llm.words import Texts, Windows, mix

SHINGLE = 5
THRESHOLD = 80  # per cent
ORDERS = 3
SAMPLE = 0.35
#: A cell's tokens, and its rows as long as that takes no more than CELLS cells along a side.
CELL_TOKENS = 500_000
CELL_ROWS = 256
CELLS = 64
_KEY_BITS = 56
_SAMPLE_SALT = np.uint64(0x2545F4914F6CDD1D)


# ---- sets ----------------------------------------------------------------------


class Sets:
    """The distinct shingles of each text, ascending, in one array."""

    def __init__(self, column, shingle: int = SHINGLE):
        texts = Texts(column, lower=True)
        n = texts.n_words
        windows = Windows(texts.hashes())
        size = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(n)), size)
        start = np.arange(int(size.sum())) - np.repeat(first, size) + texts.first[owner]
        tokens = windows.at(start, np.minimum(n, shingle)[owner])
        for a, k in zip(first.tolist(), size.tolist()):
            if k > 1:
                tokens[a : a + k].sort()
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = tokens[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(n) + 1))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per token over each set."""
        upto = np.zeros(len(values) + 1, values.dtype)
        np.cumsum(values, out=upto[1:])
        return upto[self.first[1:]] - upto[self.first[:-1]]


def prefix_length(sizes: np.ndarray, threshold: int) -> np.ndarray:
    return sizes - (threshold * sizes + 99) // 100 + 1


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``row_id, doc_id, n_shingles`` and two sums over the set, from one scan."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                sets = Sets(batch.column("text"), shingle)
                with np.errstate(over="ignore"):
                    one, two = sets.sums(mix(sets.tokens)), sets.sums(mix(sets.tokens ^ np.uint64(0x9E3779B9)))
                yield pa.record_batch(
                    [
                        batch.column("row_id"),
                        batch.column("doc_id").cast(pa.int64()),
                        pa.array(sets.sizes, pa.int64()),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                    ],
                    names=["row_id", "doc_id", "n_shingles", "sum1", "sum2"],
                )

    rows = with_row_id(docs.select("doc_id", "text"), "row_id")
    return rows.mapInArrow(sign, "row_id long, doc_id long, n_shingles long, sum1 long, sum2 long")


# ---- survivors -------------------------------------------------------------------


def _standing(classes: DataFrame, layout: B.Layout) -> DataFrame:
    """The classes' first rows as round 0 of the blocks' answers."""

    def pack(key, rows):
        ids = np.sort(rows.column("rep").to_numpy())
        return pa.table(
            {"block": [key[0].as_py()], "round": [0], "part": [0], "payload": [B.pack_arrays(ids)]},
            schema=pa.schema([("block", pa.int32()), ("round", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())]),
        )

    return classes.select("rep", layout.block_of("rep").alias("block")).groupBy("block").applyInArrow(pack, B.ANSWER)


class _Standing:
    """A block's sets, of the rows that stand for a class."""

    def __init__(self, rows: pa.Table, replies: list[bytes] | None, shingle: int, sample: float):
        ids = B.unpack_arrays(replies[0])[0] if replies else np.zeros(0, np.int64)
        self.rows = rows.filter(pa.array(np.isin(rows.column("row_id").to_numpy(), ids)))
        self.sets = Sets(self.rows.column("text"), shingle)
        with np.errstate(over="ignore"):
            draw = mix(self.sets.tokens ^ _SAMPLE_SALT)
        self.drawn = np.flatnonzero(draw <= np.uint64(int(sample * float(1 << 63)) * 2))
        keys = self.sets.tokens[self.drawn] >> np.uint64(64 - _KEY_BITS)
        self.keys, self.which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        self.twice = counts > 1


def _survivors(docs: DataFrame, classes: DataFrame, threshold: int, shingle: int, sample: float) -> DataFrame:
    """``rid, tokens`` of the classes that may have a partner."""
    layout = B.layout_of(docs)
    parts = layout.parts

    def ask(rows, earlier):
        s = _Standing(rows, earlier.get(0), shingle, sample)
        cut = B.cuts_of(s.keys, parts, _KEY_BITS)
        return [B.pack_arrays(B.gaps(s.keys[a:b]), B.bits_of(s.twice[a:b])) for a, b in zip(cut, cut[1:])]

    def survive(rows, earlier):
        s = _Standing(rows, earlier.get(0), shingle, sample)
        own = np.zeros(len(s.sets.tokens), np.int64)
        own[s.drawn] = ~shared_bits(earlier[1], len(s.keys))[s.which]
        sizes = s.sets.sizes
        stays = np.flatnonzero((sizes > 1) & (s.sets.sums(own) < prefix_length(sizes, threshold)))
        first = s.sets.first
        return pa.table(
            {
                "rid": s.rows.column("row_id").take(pa.array(stays)),
                "tokens": pa.array([s.sets.tokens[first[i] : first[i + 1]].tobytes() for i in stays], pa.binary()),
            }
        )

    dealt = B.deal(docs, layout, "text")
    standing = _standing(classes, layout)
    asked = B.questions(dealt, 1, ask, standing)
    answers = standing.unionByName(B.answered(asked, reply_shared, layout))
    return B.finish(dealt, answers, "rid long, tokens binary", survive)


def _reply_counts(payloads: list[bytes]) -> list[bytes]:
    asked = [B.unpack_arrays(p) for p in payloads]
    keys = [B.ungap(gaps) for gaps, _ in asked]
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([c for _, c in asked])).astype(np.int64)
    found, out, at = np.minimum(total, (1 << 32) - 1).astype(np.uint32)[which], [], 0
    for k in keys:
        out.append(B.pack_arrays(found[at : at + len(k)]))
        at += len(k)
    return out


def _prefixes(survivors: DataFrame, threshold: int, orders: int) -> DataFrame:
    """``rid, size, own, tokens, p0, p1, ..``: tokens others hold, and the prefixes among them."""
    layout = B.layout_of(survivors, "tokens")
    parts = layout.parts

    def sets_of(rows):
        arrays = [np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]
        return arrays, np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)

    def ask(rows, _):
        keys, counts = np.unique(sets_of(rows)[1], return_counts=True)
        cut = B.cuts_of(keys, parts)
        counts = counts.astype(np.uint32)
        return [B.pack_arrays(B.gaps(keys[a:b]), counts[a:b]) for a, b in zip(cut, cut[1:])]

    def describe(rows, earlier):
        arrays, flat = sets_of(rows)
        keys = np.unique(flat)
        found = np.concatenate([B.unpack_arrays(p)[0] for p in earlier[1]])
        if len(found) != len(keys):
            raise RuntimeError("the survivors of a block changed between two rounds")
        out: dict[str, list] = {c: [] for c in ("rid", "size", "own", "tokens", *(f"p{k}" for k in range(orders)))}
        for rid, tokens in zip(rows.column("rid").to_pylist(), arrays):
            often = found[np.searchsorted(keys, tokens)]
            own = int((often == 1).sum())
            length = int(prefix_length(np.array([len(tokens)]), threshold)[0])
            if own >= length:
                continue
            tokens, often = tokens[often > 1], often[often > 1]
            out["rid"].append(rid)
            out["size"].append(len(tokens) + own)
            out["own"].append(own)
            out["tokens"].append(tokens.tobytes())
            for k in range(orders):
                order = np.lexsort((mix(tokens ^ np.uint64(0xA0761D6478BD642F + k)), often))[: length - own]
                out[f"p{k}"].append(tokens[order].view(np.int64))
        longs = pa.list_(pa.int64())
        kinds = {"rid": pa.int64(), "size": pa.int32(), "own": pa.int32(), "tokens": pa.binary()}
        return pa.table({c: pa.array(v, kinds.get(c, longs)) for c, v in out.items()})

    dealt = B.deal(survivors, layout, "rid", "tokens")
    answers = B.answered(B.questions(dealt, 1, ask), _reply_counts, layout)
    schema = "rid long, size int, own int, tokens binary, " + ", ".join(f"p{k} array<long>" for k in range(orders))
    return B.finish(dealt, answers, schema, describe)


# ---- verification ----------------------------------------------------------------


class _Cell:
    """Documents that are compared with each other in one task."""

    def __init__(self, rows: pd.DataFrame, threshold: int, orders: int):
        self.rid = rows["rid"].to_numpy()
        self.size = rows["size"].to_numpy(np.int64)
        self.most = self.size - rows["own"].to_numpy(np.int64)  # tokens that another may hold
        self.threshold = threshold
        self.tokens = self._lists([np.frombuffer(t, np.int64) for t in rows["tokens"]])
        self.prefixes = [self._lists(list(rows[f"p{k}"])) for k in range(orders)]

    @staticmethod
    def _lists(arrays: list[np.ndarray]):
        """Each document's tokens as numbers, and each number's documents."""
        sizes = np.array([len(a) for a in arrays], np.int64)
        flat = np.concatenate(arrays) if len(arrays) else np.zeros(0, np.int64)
        _, number = np.unique(flat, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(arrays)), sizes)
        by_number = np.argsort(number, kind="stable")
        bounds = np.searchsorted(number[by_number], np.arange(number.max() + 2 if len(number) else 1))
        return number, first, owner[by_number], bounds

    @staticmethod
    def _counts(lists, i: int, n: int) -> np.ndarray:
        """How many of document ``i``'s tokens each document holds."""
        number, first, owners, bounds = lists
        mine = number[first[i] : first[i + 1]]
        if not len(mine):
            return np.zeros(n, np.int64)
        return np.bincount(np.concatenate([owners[bounds[k] : bounds[k + 1]] for k in mine]), minlength=n)

    def links_of(self, i: int, wanted: np.ndarray) -> np.ndarray:
        """Documents among ``wanted`` (flags) that are linked with ``i``."""
        n = len(self.rid)
        at_most = np.minimum(self.most[i], self.most)
        wanted = wanted & (100 * at_most >= self.threshold * (self.size[i] + self.size - at_most))
        for lists in self.prefixes:
            if not wanted.any():
                return np.zeros(0, np.int64)
            wanted &= self._counts(lists, i, n) > 0
        if not wanted.any():
            return np.zeros(0, np.int64)
        both = self._counts(self.tokens, i, n)
        return np.flatnonzero(wanted & (100 * both >= self.threshold * (self.size[i] + self.size - both)))


def _edges(a, b) -> pd.DataFrame:
    return pd.DataFrame({"a": np.asarray(a, np.int64), "b": np.asarray(b, np.int64)})


def _stars(families: DataFrame, kept: DataFrame, threshold: int, orders: int) -> DataFrame:
    """Links of every family's documents with its pivot."""

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        cell = _Cell(rows, threshold, orders)
        i = int(np.flatnonzero(cell.rid == rows["pivot"].iloc[0])[0])
        wanted = np.ones(len(rows), bool)
        wanted[i] = False
        found = cell.links_of(i, wanted)
        return _edges(cell.rid[found], np.full(len(found), cell.rid[i]))

    members = families.withColumn("cell", F.pmod(F.xxhash64("rid"), "cells").cast("int"))
    pivots = families.select("pivot", "cells").distinct()
    pivots = pivots.select("pivot", F.col("pivot").alias("rid"), "cells", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
    rows = members.unionByName(pivots).join(kept, "rid")
    return rows.groupBy("pivot", "cell").applyInPandas(verify, "a long, b long")


def _cells(rows: str) -> Column:
    return F.least(F.ceil(F.col(rows) / F.lit(CELL_ROWS)), F.lit(CELLS)).cast("int")


def _rest(families: DataFrame, kept: DataFrame, roots: DataFrame, threshold: int, orders: int) -> DataFrame:
    """Links inside families between documents that are not in one component yet."""

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        # A document may be in the cell as an outsider and as a member.
        outside = set(rows.loc[rows["outside"], "rid"])
        rows = rows.sort_values("outside").drop_duplicates("rid").reset_index(drop=True)
        cell = _Cell(rows, threshold, orders)
        _, root = np.unique(rows["root"].to_numpy(), return_inverse=True)
        members = {r: np.flatnonzero(root == r) for r in np.unique(root).tolist()}
        links: list[tuple[int, int]] = []
        for i in np.flatnonzero(rows["rid"].isin(outside).to_numpy()):
            for j in cell.links_of(int(i), root != root[i]):
                if root[j] != root[i]:
                    links.append((cell.rid[i], cell.rid[j]))
                    keep, gone = sorted((int(root[i]), int(root[j])), key=lambda r: -len(members[r]))
                    root[members[gone]] = keep  # the smaller component is renamed
                    members[keep] = np.concatenate([members[keep], members.pop(gone)])
        return _edges([a for a, _ in links], [b for _, b in links])

    root_of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    members = (
        families.unionByName(families.select("pivot", F.col("pivot").alias("rid"), "cells").distinct())
        .join(root_of("rid"), "rid", "left")
        .join(root_of("pivot"), "pivot", "left")
        .select(
            "pivot",
            "rid",
            "cells",
            F.coalesce("rid_root", "rid").alias("root"),
            (F.coalesce("rid_root", "rid") != F.coalesce("pivot_root", "pivot")).alias("outside"),
        )
    )
    members = saved(members, "members")
    open_ones = members.where("outside").groupBy("pivot").agg(F.count("*").alias("n_out"))
    rows = members.join(open_ones, "pivot").withColumn("out_cells", _cells("n_out"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n, salt: F.pmod(F.xxhash64("rid", F.lit(salt)), F.col(n)).cast("int")
    as_outside = rows.where("outside").withColumn("i", mine("out_cells", 1)).withColumn("j", every("cells"))
    as_member = rows.withColumn("j", mine("cells", 2)).withColumn("outside", F.lit(False)).withColumn("i", every("out_cells"))
    grid = as_outside.unionByName(as_member).select("pivot", "rid", "root", "outside", "i", "j")
    return grid.join(kept, "rid").groupBy("pivot", "i", "j").applyInPandas(verify, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE, sample: float = SAMPLE, orders: int = ORDERS) -> DataFrame:
    """``node, root`` of all rows (standing for their classes) that are linked with another."""
    survivors = saved(_survivors(docs, classes, threshold, shingle, sample), "survivors")
    kept = saved(_prefixes(survivors, threshold, orders), "prefixes")
    rarity = F.struct((F.col("own") / F.col("size")).alias("share"), F.col("rid").alias("rid"))
    postings = kept.select(F.explode("p0").alias("token"), "rid", rarity.alias("rarity"), F.octet_length("tokens").alias("bytes"))
    pivots = postings.groupBy("token").agg(F.min("rarity").alias("best"), F.count("*").alias("n")).where("n > 1")
    families = (
        postings.join(pivots.select("token", F.col("best.rid").alias("pivot")), "token")
        .where("rid <> pivot")
        .groupBy("pivot", "rid")
        .agg(F.first("bytes").alias("bytes"))
    )
    by_tokens = F.ceil(F.sum("bytes") / F.lit(8 * CELL_TOKENS)).cast("int").alias("by_tokens")
    sizes = families.groupBy("pivot").agg(by_tokens, F.count("*").alias("n"))
    sizes = sizes.select("pivot", F.greatest("by_tokens", _cells("n")).alias("cells"))
    families = saved(families.drop("bytes").join(sizes, "pivot"), "families")
    stars = saved(_stars(families, kept, threshold, orders), "stars")
    rest = saved(_rest(families, kept, components(stars), threshold, orders), "rest")
    return components(stars.unionByName(rest))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``row_id, doc_id, n_shingles, class_id, component_id, first_row`` of every document.

    ``class_id`` and ``component_id`` are the smallest ids of the documents with
    an equal set and of the component, ``first_row`` its smallest row number.
    ``docs`` has ``doc_id`` and ``text``; for row numbers that another scan
    repeats it is a scan of a table.
    """
    docs = as_table(docs)
    signed = saved(_signatures(docs, shingle), "signatures")
    key = ["n_shingles", "sum1", "sum2"]
    classes = signed.where("n_shingles > 0").groupBy(*key).agg(F.min("row_id").alias("rep"), F.min("doc_id").alias("class_id"))
    classes = saved(classes, "classes")
    roots = links(docs, classes, threshold, shingle)
    placed = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    whole = placed.groupBy("root").agg(F.min("class_id").alias("component_id"), F.min("rep").alias("first_row"))
    placed = placed.join(whole, "root").select(*key, "class_id", "component_id", "first_row")
    found = signed.where("n_shingles > 0").join(placed, key).drop("sum1", "sum2")
    alone = signed.where("n_shingles = 0").select(
        "row_id", "doc_id", "n_shingles",
        F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.col("row_id").alias("first_row"),
    )
    return found.select(alone.columns).unionByName(alone)


def jaccard_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "class_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with the first row of each component.

    Documents without words are linked with nothing and all stay.
    """
    docs = as_table(docs)
    key = spare_name(docs, "row_id")
    firsts = near_duplicates(docs).where("row_id = first_row").select(F.col("row_id").alias(key))
    return with_row_id(docs, key).join(firsts, key, "left_semi").drop(key)
