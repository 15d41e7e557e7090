"""Source divergence audit: how far the words of each source lie from those of the other sources of its language.

Term frequencies come from single-pass in-memory indexing. A task adds the postings of its texts to a block in
memory; when the block is full it is spilled as runs sorted by term, one for each hash shard. A shard's
runs are merged through a heap into the frequencies of its terms, and only terms that enough documents of a language hold stay.

With p = 1 + floor(10^9 (count + 2) / (N + 2 V)) for each kept term, the distance of two sources is the sum of
f(p, q) = floor((p - q)^2 / (p + q)) over all V terms, also those that neither has. No table of V terms by source is
made: a source's terms of one count share one p, and all absent terms share one. So the sum starts as if no term occurred,
is corrected for the terms of either source by its table of counts, and then for the terms of both, in a
stream over the merged frequencies that adds up one number for each pair of sources.

Defined cases: null text, language and source are read as empty; the empty name is a name like any other; a language or source
without kept terms has distance 0 to its neighbours if V is 0; repeated rows are documents of their own; texts of any length are
read whole; equal values are ranked by the item's UTF-8 bytes; an empty table gives an empty result; other columns are not read.
The result has a row for each pair of sources of a language, so their number is taken to be that of a label column.
"""
from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize, offsets_of, slices

LEAST_DOCUMENTS = 10  # of a language that hold a kept term
TOP_TERMS = 10
BLOCK_BYTES = 64_000_000  # of postings that a task holds before it spills
POSTING_BYTES = 130  # that a posting takes besides its term
SHARD_BYTES = 32_000_000  # of text for each hash shard
OPEN_TERMS = 64  # of a run that a merge has unpacked
DOCUMENT = 1 << 48  # a posting's number holds its documents above its occurrences
#: Lower-cases A-Z, keeps a-z and all bytes of other letters, and makes the rest blank.
TERM_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RUN = "shard int, groups array<struct<lang: string, source: string>>, n_terms long, lengths binary, n_postings binary, terms binary, postings binary"
POSTING = np.dtype([("group", "<u4"), ("count", "<u8"), ("docs", "<u4")])


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_LETTERS).split()


class Block:
    """Postings in memory: for each (language, source), its terms with occurrences and documents."""

    def __init__(self, shards: int):
        self.shards, self.size, self.groups = shards, 0, {}

    def add(self, group: tuple[str, str], text: bytes) -> None:
        known, size = self.groups.setdefault(group, {}), 0
        for term, n in Counter(terms_of(text)).items():
            if term in known:
                known[term] += n + DOCUMENT
            else:
                known[term] = n + DOCUMENT
                size += len(term) + POSTING_BYTES
        self.size += size

    def spill(self) -> Iterator[dict]:
        """One run for each shard that has terms, sorted by term; the block is empty afterwards."""
        by_term: dict[bytes, list[tuple[int, int, int]]] = {}
        for g, known in enumerate(self.groups.values()):
            for term, n in known.items():
                by_term.setdefault(term, []).append((g, n % DOCUMENT, n // DOCUMENT))
        names = [{"lang": lang, "source": source} for lang, source in self.groups]
        runs: dict[int, list[bytes]] = {}
        for term in sorted(by_term):
            runs.setdefault(zlib.crc32(term) % self.shards, []).append(term)
        for shard, terms in runs.items():
            postings = [by_term[t] for t in terms]
            row = {"shard": shard, "groups": names, "n_terms": len(terms),
                   "lengths": np.array([len(t) for t in terms], "<u4").tobytes(),
                   "n_postings": np.array([len(p) for p in postings], "<u4").tobytes(), "terms": b"".join(terms),
                   "postings": np.array([x for p in postings for x in p], POSTING).tobytes()}
            yield row
        self.groups, self.size = {}, 0


def walk(run: dict) -> Iterator[tuple[bytes, list[tuple[str, str]], list[tuple[int, int, int]]]]:
    """(term, groups, postings) of a run in term order; a run stays packed but for a few terms at a time."""
    at, first = (offsets_of(np.frombuffer(run[c], "<u4")) for c in ("lengths", "n_postings"))
    groups, terms = [(g["lang"], g["source"]) for g in run["groups"]], run["terms"]
    postings = np.frombuffer(run["postings"], POSTING)
    for low in range(0, run["n_terms"], OPEN_TERMS):
        high = min(low + OPEN_TERMS, run["n_terms"])
        found = postings[first[low]:first[high]].tolist()
        bounds, places = at[low:high + 1].tolist(), (first[low:high + 1] - first[low]).tolist()
        for i in range(high - low):
            yield terms[bounds[i]:bounds[i + 1]], groups, found[places[i]:places[i + 1]]


def merged(runs: list[dict], least: int) -> Iterator[tuple[str, str, str, int, int, bool]]:
    """(lang, term, source, count, the language's count, first of its term) of the kept terms of a shard's runs."""
    for term, parts in groupby(heapq.merge(*map(walk, runs), key=itemgetter(0)), key=itemgetter(0)):
        found: dict[str, dict[str, list[int]]] = {}
        for _, groups, postings in parts:
            for g, n, docs in postings:
                lang, source = groups[g]
                seen = found.setdefault(lang, {}).setdefault(source, [0, 0])
                seen[0] += n
                seen[1] += docs
        for lang, sources in found.items():
            if sum(d for _, d in sources.values()) >= least:
                total, word = sum(n for n, _ in sources.values()), term.decode("utf-8")
                for i, (source, (n, _)) in enumerate(sources.items()):
                    yield lang, word, source, n, total, i == 0


def frequencies(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                least: int = LEAST_DOCUMENTS, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, term, source, count, total, first): occurrences of each kept term in each source that holds it.

    ``total``: those in its language; ``first`` is true in one row of each (lang, term).
    """
    slim = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = int(size // shard_bytes) + 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shards)
        for batch in slices(batches, 2):
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                block.add((langs[i], sources[i]), text)
                if block.size >= block_bytes:
                    yield from packed(block.spill())
        yield from packed(block.spill())

    kinds = pa.schema([("shard", pa.int32()), ("groups", pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string())]))), ("n_terms", pa.int64()),
                       *((c, pa.binary()) for c in ("lengths", "n_postings", "terms", "postings"))])

    def packed(runs: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for run in runs:
            yield pa.RecordBatch.from_pylist([run], kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for part in slices([batch], rows=1) for row in part.to_pylist())
        for _, runs in groupby(rows, key=itemgetter("shard")):
            out = []
            for row in merged(list(runs), least):
                out.append(row)
                if len(out) == 50_000:
                    yield flat(out)
                    out = []
            yield flat(out)

    def flat(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * 6
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "term", "source", "count", "total", "first"])

    runs = slim.mapInArrow(index, RUN).repartition(max(2, shards), "shard").sortWithinPartitions("shard")
    return runs.mapInArrow(merge, "lang string, term string, source string, count long, total long, first boolean")


def share(count: Column, n: Column, v: Column) -> Column:
    """p of a term: exact for any counts; V is not 0 where a term is."""
    numerator = (count.cast("decimal(20,0)") + 2) * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", numerator, F.greatest(n + 2 * v, F.lit(1)).cast("decimal(20,0)"))


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shared_corrections(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream (lang, term, source, p, base), a term's rows together, into (lang, a, b, correction) sums, a < b.

    For a term that both sources hold the sum so far has f(p, base') + f(base, p') - f(base, base') in place of f(p, p').
    """
    f = lambda p, q: (p - q) * (p - q) // (p + q)
    names: dict[tuple[str, str], int] = {}
    total: dict[int, int] = {}
    rest = None
    for batch in chain(rows, [None]):
        parts = [b for b in (rest, batch) if b is not None and b.num_rows]
        if not parts:
            continue
        table = pa.Table.from_batches(parts).combine_chunks()
        key = [(a, b) for a, b in zip(table.column("lang").to_pylist(), table.column("term").to_pylist())]
        if batch is not None:  # the last term may go on
            last = len(key)
            while last and key[last - 1] == key[-1]:
                last -= 1
            rest = table.slice(last).combine_chunks().to_batches()[0]
            table, key = table.slice(0, last), key[:last]
            if not last:
                continue
        number = np.cumsum([True] + [a != b for a, b in zip(key[1:], key)])
        who = np.array([names.setdefault((x[0], s), len(names)) for x, s in zip(key, table.column("source").to_pylist())], np.int64)
        p, base = (table.column(c).to_numpy().astype(np.int64) for c in ("p", "base"))
        for k in range(1, len(number)):
            i = np.flatnonzero(number[k:] == number[:-k])
            if not len(i):
                break
            j = i + k
            fix = f(p[i], p[j]) - f(p[i], base[j]) - f(base[i], p[j]) + f(base[i], base[j])
            pair = np.minimum(who[i], who[j]) << 32 | np.maximum(who[i], who[j])
            found, at = np.unique(pair, return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, at, fix)
            for x, n in zip(found.tolist(), sums.tolist()):
                total[x] = total.get(x, 0) + n
        if len(total) > 500_000:
            yield from _sums(total, names)
            total = {}
    yield from _sums(total, names)


def _sums(total: dict[int, int], names: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    who = list(names)
    rows = [(who[x >> 32], who[x & 0xFFFFFFFF], n) for x, n in total.items()]
    columns = [[a[0] for a, _, _ in rows], [a[1] for a, _, _ in rows], [b[1] for _, b, _ in rows], [n for *_, n in rows]]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()))],
                                     names=["lang", "a", "b", "correction"])


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, **limits) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's distance to the other sources of its language (part
    ``pair``), and the terms it has more of than its language (part ``term``), the ``top`` first ones."""
    freq = materialize(frequencies(docs, lang_col, source_col, text_col, least, **limits), "term-frequencies")
    names = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    langs = freq.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum(F.when(F.col("first"), F.col("total"))).alias("n_lang"))
    counts = freq.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = names.join(counts, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("n"), zero("v"), zero("n_lang"))
    groups = groups.withColumn("base", share(F.lit(0), F.col("n"), F.col("v")))
    groups = materialize(groups, "term-groups")

    known = freq.join(groups, ["lang", "source"])
    known = known.withColumn("p", share(F.col("count"), F.col("n"), F.col("v")))

    best = known.withColumn("q", share(F.col("total"), F.col("n_lang"), F.col("v"))).where("p > q")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    best = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    best = best.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # a source's terms against a source without them, by the source's table of counts
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other_base"))
    alone = known.groupBy("lang", "source", "p", "base").agg(F.count(F.lit(1)).alias("n_terms")).join(other, "lang").where("source <> item")
    alone = alone.select("lang", "source", "item", (F.col("n_terms") * (apart(F.col("p"), F.col("other_base")) - apart(F.col("base"), F.col("other_base")))).alias("part_value"))
    start = groups.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("v") * apart(F.col("base"), F.col("other_base"))).alias("part_value"))
    together = known.select("lang", "term", "source", "p", "base").repartition("lang", "term").sortWithinPartitions("lang", "term")
    both = together.mapInArrow(shared_corrections, "lang string, a string, b string, correction long")
    turned = lambda df, a, b, value: df.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), F.col(value).alias("part_value"))
    both = materialize(both.groupBy("lang", "a", "b").agg(F.sum("correction").alias("correction")), "term-corrections")
    alone = materialize(alone.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("part_value")), "term-pairs")
    parts = start.union(alone).union(turned(alone, "item", "source", "part_value")).union(
        turned(both, "a", "b", "correction")).union(turned(both, "b", "a", "correction"))
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    return pairs.unionByName(best)


#: The same rows in DuckDB: every source of a language against every other, over all its kept terms.
ORACLE_SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce("text", '') as body from documents),
t as (select r, lang, source, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as total from t group by lang, term having count(distinct r) >= 10),
c as (select t.lang, t.source, t.term, count(*) as n from t join kept using (lang, term) group by all),
g as (select distinct lang, source from d),
v as (select lang, count(*) as v, sum(total) as n_lang from kept group by lang),
w as (select lang, source, sum(n) as n from c group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, cast(1 + (cast(coalesce(c.n, 0) as hugeint) + 2) * 1000000000 // (coalesce(w.n, 0) + 2 * v.v) as hugeint) as p,
             cast(1 + (cast(k.total as hugeint) + 2) * 1000000000 // (v.n_lang + 2 * v.v) as hugeint) as q
      from g join kept k using (lang) join v using (lang) left join w using (lang, source) left join c using (lang, source, term)),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item,
                 coalesce((select sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) from p x join p y on y.lang = x.lang and y.term = x.term and y.source = b.source where x.lang = a.lang and x.source = a.source), 0) as value
          from g a join g b on a.lang = b.lang and a.source <> b.source),
terms as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value from p where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 10
"""
