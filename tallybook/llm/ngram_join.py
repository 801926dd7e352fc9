"""Similarity join of documents on word n-gram sets: a grouped prefix join.

Documents link when the Jaccard similarity of their shingle sets is at least ``threshold``. Two such
sets share a member among their first few in any common order, so only prefixes are indexed; here
the order is rarest first. Documents with the same size and the same prefix form one group, group
pairs are filtered by size and place, and only the rest is expanded to members and verified on whole
sets. Verification returns as many links as connect what it compared, never all pairs of a family
of copies.

Stages, each a shuffle of packed arrays:

1. size and checksum of every set; equal sets are one document from here on;
2. documents are kept if enough of a longer prefix (by hash) occurs anywhere else: a necessary
   condition for a partner, found at buckets of hashes, to which a task sends a value once;
3. the sets of those that are left, their document frequencies, and their prefixes, rarest first;
4. families (same rarest shared member) verified where they lie, in blocks of bounded size;
5. group pairs that share a prefix member and are not yet connected, verified where the family of
   one of them lies;
6. components.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallybook.llm.blocks import (
    documents, mix, outer_ids, pack, pack_sorted, partitions, releasing, text_array, text_batches, unique_ids, unpack,
    unpack_sorted, unzip, written_table, zipped,
)
from tallybook.llm.components import components, joined
from tallybook.llm.shingles import shingle_sets
from tallybook.plans.ordering import number_rows

_FLUSH = 1 << 19  # prefix members a task gathers before it sends them off
FAMILY_BLOCK = 1024  # documents compared with each other in one place


def _overlap_needed(n: int, t: Fraction) -> int:
    """Least overlap of a set of size ``n`` with any partner: the union is at least ``n``."""
    return -(-n * t.numerator // t.denominator)


def _extra(n: int) -> int:
    """How many shared members of the longer prefix are asked for; grows with the size."""
    return max(1, n * 15 // 100)


def _similar(overlap, n, m, t: Fraction):
    return overlap * t.denominator >= (n + m - overlap) * t.numerator


def _signed(values):
    return np.asarray(values, np.uint64).view(np.int64)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def set_summary(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``n`` and two checksums of every document's shingle set."""

    def run(batches):
        for ids, data, offsets in text_batches(batches):
            sets = shingle_sets(data, offsets, size)
            sums = [(s.sum(dtype=np.uint64), mix(s + np.uint64(11)).sum(dtype=np.uint64)) for s in sets]
            s1, s2 = (_signed([x[i] for x in sums]) for i in (0, 1))
            yield _batch(doc_id=ids, n=np.array([len(s) for s in sets], np.int64), s1=s1, s2=s2)

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long")


def _sent(tokens: np.ndarray, docs: np.ndarray, buckets: int):
    """What a task sends of its prefix members: single ones with their document, others once."""
    bucket = (mix(tokens.copy()) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((tokens, bucket))
    tokens, docs, bucket = tokens[order], docs[order], bucket[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    at = np.flatnonzero(new)
    many = np.diff(at, append=len(tokens)) > 1
    single, several = at[~many], at[many]
    inside = np.ones(len(tokens), bool)
    inside[single] = False
    local, counts = np.unique(docs[inside], return_counts=True)
    # A row for each bucket that gets members, so that there are never more rows than values.
    there = np.unique(bucket)
    share = np.array_split(np.arange(len(local)), max(1, len(there)))
    a = np.searchsorted(bucket[single], np.arange(buckets + 1))
    b = np.searchsorted(bucket[several], np.arange(buckets + 1))
    rows = {"bucket": there, "tokens": [], "docs": [], "several": [], "local": [], "counts": []}
    for k, mine in zip(there, share):
        one, more = single[a[k] : a[k + 1]], several[b[k] : b[k + 1]]
        rows["tokens"].append(pack_sorted(tokens[one]))
        rows["docs"].append(pack(docs[one]))
        rows["several"].append(pack_sorted(tokens[more]))
        rows["local"].append(pack(local[mine]))
        rows["counts"].append(pack(counts[mine]))
    return _batch(**rows)


def shared_counts(docs: DataFrame, size: int, t: Fraction) -> DataFrame:
    """``doc_id``, ``shared``: how many of a document's smallest hashes another document has too."""
    parts = partitions(docs)
    buckets = 2 * parts

    def send(batches):
        tokens, owners, held = [], [], 0
        for ids, data, offsets in text_batches(batches):
            for doc, s in zip(ids, shingle_sets(data, offsets, size)):
                n = len(s)
                if n:
                    tokens.append(s[: n - _overlap_needed(n, t) + _extra(n)])
                    owners.append(np.full(len(tokens[-1]), doc, np.int64))
                    held += len(tokens[-1])
            if held > _FLUSH:
                yield _sent(np.concatenate(tokens), np.concatenate(owners), buckets)
                tokens, owners, held = [], [], 0
        if tokens:
            yield _sent(np.concatenate(tokens), np.concatenate(owners), buckets)

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        singles = [unpack_sorted(b) for b in rows["tokens"]]
        several = [unpack_sorted(b) for b in rows["several"]]
        tokens = np.concatenate(singles)
        docs = np.concatenate([unpack(b, np.int64) for b in rows["docs"]])
        # A value sent once for several documents counts twice, so that it is shared for all.
        known, at, n = np.unique(
            np.concatenate([tokens, *several, *several]), return_inverse=True, return_counts=True
        )
        mine = docs[n[at[: len(tokens)]] > 1]
        found, counts = np.unique(mine, return_counts=True)
        docs = np.concatenate([found, *[unpack(b, np.int64) for b in rows["local"]]])
        counts = np.concatenate([counts, *[unpack(b, np.int64) for b in rows["counts"]]])
        part = (mix(docs.view(np.uint64).copy()) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((docs, part))
        there, starts = np.unique(part[order], return_index=True)
        cuts = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
        return pa.table(
            {"part": there, "docs": [pack(docs[c]) for c in cuts], "counts": [pack(counts[c]) for c in cuts]},
            schema=pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary())]),
        )

    def total(table: pa.Table) -> pa.Table:
        docs, counts = (
            np.concatenate([unpack(b, np.int64) for b in table.column(c).to_pylist()]) for c in ("docs", "counts")
        )
        found, at = np.unique(docs, return_inverse=True)
        shared = np.zeros(len(found), np.int64)
        np.add.at(shared, at, counts)
        return pa.table({"doc_id": found, "shared": shared})

    sent = docs.mapInArrow(
        send, "bucket int, tokens binary, docs binary, several binary, local binary, counts binary"
    )
    counted = sent.groupBy("bucket").applyInArrow(releasing(count), "part int, docs binary, counts binary")
    return counted.groupBy("part").applyInArrow(releasing(total), "doc_id long, shared long")


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int, parts: int) -> DataFrame:
    """``part``, ``doc_id``, ``tokens`` of the wanted documents."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc, blob in zip(ids, batch.column("ztext").to_pylist()):
                data = np.frombuffer(unzip(blob), np.uint8)
                s = shingle_sets(data, np.array([0, len(data)]), size)[0]
                yield _batch(doc_id=[doc], tokens=[s.tobytes()])

    def gathered(batches):
        rows = {"doc_id": [], "tokens": []}
        for row in run(batches):
            rows["doc_id"] += row.column(0).to_pylist()
            rows["tokens"] += row.column(1).to_pylist()
            if len(rows["doc_id"]) >= 1000:
                yield _batch(**rows)
                rows = {"doc_id": [], "tokens": []}
        if rows["doc_id"]:
            yield _batch(**rows)

    texts = zipped(docs).join(wanted.select("doc_id"), "doc_id")
    sets = texts.mapInArrow(gathered, "doc_id long, tokens binary")
    return sets.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))


def _prefixes(sets: DataFrame, t: Fraction) -> DataFrame:
    """``doc_id``, ``n``, ``prefix``: shared prefix members, rarest first; documents without one drop out."""
    buckets = 2 * partitions(sets)

    def tell(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        data, _ = text_array(table.column("tokens"))
        tokens, counts = np.unique(np.ascontiguousarray(data).view(np.uint64), return_counts=True)
        bucket = (mix(tokens.copy()) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        there = np.flatnonzero(np.diff(cuts))
        rows = [order[cuts[k] : cuts[k + 1]] for k in there]
        return pa.table({
            "bucket": there.astype(np.int32), "part": np.full(len(there), part, np.int32),
            "tokens": pa.array([pack_sorted(tokens[r]) for r in rows], pa.binary()),
            "counts": pa.array([pack(counts[r].astype(np.int64)) for r in rows], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        tokens = [unpack_sorted(b) for b in rows["tokens"]]
        known, at = np.unique(np.concatenate(tokens), return_inverse=True)
        counts = np.concatenate([unpack(b, np.int64) for b in rows["counts"]])
        total = np.zeros(len(known), np.int64)
        np.add.at(total, at, counts)
        out, seen = {"part": [], "tokens": [], "df": []}, 0
        for part, mine in zip(rows["part"], tokens):
            df = total[at[seen : seen + len(mine)]]
            seen += len(mine)
            out["part"].append(part)
            out["tokens"].append(pack_sorted(mine[df > 1]))
            out["df"].append(pack(df[df > 1]))
        return pa.table(out, schema=pa.schema([("part", pa.int32()), ("tokens", pa.binary()), ("df", pa.binary())]))

    def pick(sets: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.to_pydict()
        known = np.concatenate([np.empty(0, np.uint64), *[unpack_sorted(b) for b in rows["tokens"]]])
        df = np.concatenate([np.empty(0, np.int64), *[unpack(b, np.int64) for b in rows["df"]]])
        order = np.argsort(known)
        known, df = known[order], df[order]
        out = {"doc_id": [], "n": [], "prefix": []}
        for doc, blob in zip(sets.column("doc_id").to_pylist(), sets.column("tokens").to_pylist()):
            mine = np.frombuffer(blob, np.uint64)
            n = len(mine)
            at = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
            hit = known[at] == mine if len(known) else np.zeros(n, bool)
            places = n - _overlap_needed(n, t) + 1 - int((~hit).sum())
            if places > 0:
                mine, often = mine[hit], df[at[hit]]
                first = np.lexsort((mine, often))[:places]
                out["doc_id"].append(doc)
                out["n"].append(n)
                out["prefix"].append(_signed(mine[first]))
        return pa.table(out, schema=pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64()))]))

    told = sets.groupBy("part").applyInArrow(releasing(tell), "bucket int, part int, tokens binary, counts binary")
    answers = told.groupBy("bucket").applyInArrow(releasing(answer), "part int, tokens binary, df binary")
    return sets.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        pick, "doc_id long, n long, prefix array<long>"
    )


def _forest(ids: list, sets: list[np.ndarray], t: Fraction, label: list | None = None, asked: dict | None = None):
    """Links that connect what is similar among ``sets``; pairs already connected are not compared.

    ``label`` starts components off; with ``asked`` (place -> places) only those pairs are compared.
    """
    size = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(size)])
    flat, at = np.unique(np.concatenate(sets), return_inverse=True) if len(sets) else (np.empty(0), np.empty(0, int))
    mark = np.zeros(len(flat), np.int64)
    comp = np.arange(len(sets)) if label is None else np.unique(np.asarray(label), return_inverse=True)[1]
    comp = comp.copy()
    a, b = [], []
    for i in range(len(sets)):
        others = np.arange(i + 1, len(sets)) if asked is None else np.array(asked.get(i, ()), np.int64)
        if not len(others):
            continue
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[(comp[others] != comp[i]) & _similar(low, low, high, t)]
        if not len(others):
            continue
        mark[at[starts[i] : starts[i + 1]]] = 1
        spans = [mark[at[starts[j] : starts[j + 1]]].sum() for j in others]
        mark[at[starts[i] : starts[i + 1]]] = 0
        for j in others[_similar(np.array(spans), size[i], size[others], t)]:
            if comp[j] != comp[i]:
                a.append(ids[i])
                b.append(ids[j])
                comp[comp == comp[j]] = comp[i]
    return a, b


def _links_table(a, b) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _family_links(homes: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """Links inside family blocks."""

    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_pylist()
        return _links_table(*_forest(ids, [np.frombuffer(b, np.uint64) for b in table.column("tokens").to_pylist()], t))

    placed = sets.select("doc_id", "tokens").join(homes.select("doc_id", "home", "salt", "beside").where("beside > 1"), "doc_id")
    return placed.select("home", "salt", "doc_id", "tokens").groupBy("home", "salt").applyInArrow(releasing(verify), "a long, b long")


def _groups(homes: DataFrame, named: DataFrame, t: Fraction) -> tuple[DataFrame, DataFrame]:
    """(one row per group and component in it, led by its smallest member; the members of each)."""
    labelled = homes.join(named, F.col("doc_id") == F.col("node"), "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "doc_id"))
    leads = labelled.groupBy("gid", "component").agg(F.min("doc_id").alias("lead"))
    members = written_table(
        labelled.join(leads, ["gid", "component"]).select("lead", "doc_id", "n", "prefix", "component"), "members"
    )
    needed = F.ceil(F.col("n") * t.numerator / t.denominator - F.lit(1e-6))
    unshared = F.col("n") - needed + 1 - F.size("prefix")
    groups = members.where("lead = doc_id").select(F.col("lead").alias("gid"), "n", "prefix", "component", unshared.alias("unshared"))
    return groups, members.select("lead", "doc_id")


def _group_pairs(groups: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of groups that share a prefix member, may be similar, and are not connected yet.

    ``groups``: gid, n, prefix, unshared (members before the prefix), component.
    """
    entries = groups.select(
        "gid", "n", "component", "unshared", F.posexplode("prefix").alias("place", "token")
    )
    entries = entries.withColumn("place", F.col("place") + F.col("unshared"))
    # A member that only one component has leads to no new link.
    wide = entries.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    wide = wide.where("lo != hi").select("token")
    entries = entries.join(wide, "token")
    # Entries of a member lie in blocks of bounded size; pairs are found between blocks, and an entry
    # comes out with all its partners in one array.
    size = entries.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK).alias("blocks"))
    entry = F.struct("gid", "n", "component", "place")
    blocked = entries.join(size, "token").groupBy("token", F.pmod(F.xxhash64("gid"), F.col("blocks")).alias("block")).agg(
        F.collect_list(entry).alias("entries")
    )
    one = blocked.select("token", F.col("entries").alias("left"))
    two = blocked.select("token", F.col("entries").alias("right"))
    each = one.join(two, "token").select(F.explode("left").alias("x"), "right")

    def may_link(y: Column) -> Column:
        x = F.col("x")
        rest = F.least(x["n"] - x["place"], y["n"] - y["place"])
        short, long = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
        after = (x["n"] < y["n"]) | ((x["n"] == y["n"]) & (x["gid"] < y["gid"]))
        return (
            after & (x["component"] != y["component"]) & (short * t.denominator >= long * t.numerator)
            & (rest * (t.denominator + t.numerator) >= (x["n"] + y["n"]) * t.numerator)
        )

    partner = F.transform(
        F.filter("right", may_link), lambda y: F.struct(y["gid"].alias("b"), y["component"].alias("cb"))
    )
    found = each.select(F.col("x.gid").alias("a"), F.col("x.component").alias("ca"), partner.alias("partners"))
    found = found.where(F.size("partners") > 0).groupBy("a", "ca")
    found = found.agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
    return found.select("a", "ca", F.inline("partners"))


def _pair_links(pairs: DataFrame, homes: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """Links among member pairs ``(a, b, ca, cb)``; the set of b goes once to each place that asks for it."""
    where_a = homes.select(F.col("doc_id").alias("a"), "home", "salt")
    asked = written_table(pairs.join(where_a, "a"), "asked")
    needed = asked.select("home", "salt", F.col("a").alias("doc_id")).union(asked.select("home", "salt", "b")).distinct()
    shipped = needed.join(sets.select("doc_id", "tokens"), "doc_id").select(
        "home", "salt", "doc_id", "tokens", *[F.lit(None).cast("bigint").alias(c) for c in ("b", "ca", "cb")]
    )
    asks = asked.select(
        "home", "salt", F.col("a").alias("doc_id"), F.lit(None).cast("binary").alias("tokens"), "b", "ca", "cb"
    )

    def verify(table: pa.Table) -> pa.Table:
        has_set = table.column("tokens").is_valid()
        own, pair = table.filter(has_set), table.filter(pa.compute.invert(has_set)).to_pydict()
        ids = own.column("doc_id").to_pylist()
        place = {doc: i for i, doc in enumerate(ids)}
        label, asked = [-1 - i for i in range(len(ids))], {}
        for doc, b, ca, cb in zip(pair["doc_id"], pair["b"], pair["ca"], pair["cb"]):
            label[place[doc]], label[place[b]] = ca, cb
            asked.setdefault(place[doc], []).append(place[b])
        found = [np.frombuffer(b, np.uint64) for b in own.column("tokens").to_pylist()]
        return _links_table(*_forest(ids, found, t, label, asked))

    return shipped.unionByName(asks).groupBy("home", "salt").applyInArrow(releasing(verify), "a long, b long")


def ngram_components(
    docs: DataFrame, size: int = 4, percent: int = 85, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every document.

    Words are lower-cased (A-Z) runs of anything but white space; a set holds the distinct shingles
    of ``size`` words, or the whole sequence where there are fewer. Sets link when
    100 * intersection >= ``percent`` * union, exactly; a component is named by its smallest id.
    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows
    that repeat an id, or have none, are one document each. Other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    t = Fraction(percent, 100)
    docs, names = unique_ids(documents(docs, id_column, text_column))
    parts = partitions(docs)
    summary = written_table(set_summary(docs, size), "summary")
    classes = summary.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    counts = shared_counts(docs, size, t)
    # A partner has at least this many of its own, longer prefix in common.
    least = F.greatest(
        F.lit(1), F.floor(F.ceil(F.col("n") * t.numerator / t.denominator - F.lit(1e-6)) * 15 / 100)
    )
    live = counts.join(classes.select(F.col("rep").alias("doc_id"), "n"), "doc_id").where(F.col("shared") >= least)
    live = written_table(live.select("doc_id", "n").distinct(), "live")
    sets = written_table(_sets_of(docs, live, size, parts), "sets")
    prefixes = written_table(_prefixes(sets, t), "prefixes")
    keyed = prefixes.withColumn("home", F.element_at("prefix", 1))
    family = keyed.groupBy("home").agg(F.count(F.lit(1)).alias("beside"))
    gid = keyed.groupBy("n", "prefix").agg(F.min("doc_id").alias("gid"))
    homes = keyed.join(gid, ["n", "prefix"]).join(family, "home")
    blocks = F.ceil(F.col("beside") / FAMILY_BLOCK)
    homes = homes.withColumn("salt", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
    homes = written_table(homes.select("doc_id", "gid", "n", "prefix", "home", "salt", "beside"), "homes")
    named = components(written_table(_family_links(homes, sets, t), "family"))
    # Leaders first: most families are then connected before any members are compared across them.
    for whole in (False, True):
        groups, members = _groups(homes, named, t)
        pairs = written_table(_group_pairs(groups, t), "pairs")
        if whole:
            pairs = (
                pairs.withColumnRenamed("a", "lead").join(members.withColumnRenamed("doc_id", "a"), "lead").drop("lead")
                .withColumnRenamed("b", "lead").join(members.withColumnRenamed("doc_id", "b"), "lead").drop("lead")
            )
        named = joined(named, written_table(_pair_links(pairs, homes, sets, t), "across"))
    classed = summary.join(classes, ["n", "s1", "s2"], "left")
    found = classed.join(named, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return outer_ids(found, names, "doc_id", "component_id")


def one_per_component(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that name their component, with all their columns.

    Of rows that repeat an id, or have none, each is a document of its own.
    """
    ids = docs.groupBy(id_column).agg(F.count(F.lit(1)).alias("_n"))
    key = id_column
    if not ids.where(f"_n > 1 OR `{id_column}` IS NULL").isEmpty():
        key = "_key"
        while key in docs.columns:
            key += "_"
        order = [F.col(id_column).asc_nulls_first(), F.col(text_column).asc_nulls_first()]
        docs = written_table(number_rows(docs, [], order, key), "numbered")
    found = ngram_components(docs, size, percent, key, text_column)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(key))
    kept = docs.join(kept, key, "left_semi")
    return kept if key == id_column else kept.drop(key)
