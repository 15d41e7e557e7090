"""Secret scans: fixed patterns, and a randomness test battery for what no pattern names, by DataFrame expressions alone.

Patterns (leftmost, not overlapping, per kind): an assignment to a secret's name, an access key, a long hex run. A
pattern match that is too short is dropped after matching, so it still hides what it covers.

Battery: every long run of letters, digits and ``+/_-`` is a candidate, and so is every long piece of it between
separators (``/``, ``_`` and ``-``, each taken as one or not). Of accepted ones that overlap, the one with the most evidence
is added, then the longest. The encoding is inferred (digits, hex, letters, base32, alphanumeric in one case or both, base58,
base64); in the alphabets of one case separators only group the symbols and are not tested. Three tests ask whether it is uniform in that alphabet: chi-squared over its
symbols, runs above and below the middle of the alphabet, serial correlation of neighbours. A candidate that
fails one is text. For the others two tests ask how likely text is to look like this: it has as few equal symbols, or as many
changes between lower case, upper case and digits. Both depend on the length, so short candidates need more evidence.
The p-values of all candidates of the corpus go through a Benjamini-Hochberg step-up, which bounds the share of
false discoveries among the spans added.

Defined cases: a null text has no spans; spans count code points, end exclusive; texts of any length are scanned
whole; repeated rows each give a row and count each among the candidates; an added span that touches a pattern's span is
left out; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize, whole_row

#: Fixed patterns of the contract: kind, pattern, group and least length of what it matches.
PATTERNS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a whole run either way, since it is one class
]
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: The pieces of a candidate by which of the separators divide it.
PIECES = [f"[A-Za-z0-9+{kept}]{{20,}}" for kept in ("_-", "/-", "/_", "-", "_", "/", "")]
SEPARATORS = "/_-"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets of one case, the first that holds a whole candidate, without its separators, is its encoding.
ONE_CASE = [DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, LOWER + "234567", UPPER + "234567",
            DIGITS + "abcdefghjkmnpqrstvwxyz", DIGITS + "ABCDEFGHJKMNPQRSTVWXYZ", DIGITS + LOWER, DIGITS + UPPER]
#: Else the first of these that holds it with them.
BOTH_CASES = [UPPER + LOWER, "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz", DIGITS + UPPER + LOWER,
              DIGITS + UPPER + LOWER + "+/", DIGITS + UPPER + LOWER + "-_", DIGITS + UPPER + LOWER + "+/-_"]
UNIFORM_P = 1e-3  # below it a test finds a candidate not uniform
TEXT_EQUAL, TEXT_TRIPLE = 0.065, 0.0055  # chance that two, and three, letters of text are equal
TEXT_CHANGE = 0.08  # chance that neighbours in text differ in kind
FALSE_SHARE = 0.01
BIN = 0.05  # of -log10 p
MOST_BINS = 2000
BLOCK = 64


def with_spans(df: DataFrame, text_col: str, pattern: str, out: str) -> DataFrame:
    """Add array<struct<start, end, value>> of a pattern's matches.

    Starts are sums of the lengths of matches and of the pieces between them, in blocks, so that a text with
    very many matches does not cost their square.
    """
    df = df.withColumn("_m", F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0)))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(text_col, pattern, -1)))
    n = F.size("_m")
    df = df.withColumn("_g", F.zip_with(F.slice("_p", 1, n), "_m", lambda p, m: F.length(p) + F.length(m)))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: total(F.slice("_g", b * BLOCK + 1, F.lit(BLOCK))))
    df = df.withColumn("_b", F.when(n > 0, blocks))
    df = df.withColumn("_b", F.transform("_b", lambda x, b: total(F.slice("_b", F.lit(1), b))))

    def span(m: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        start = F.get("_b", block) + total(F.slice("_g", block * BLOCK + 1, i - block * BLOCK)) + F.length(F.get("_p", i))
        return F.struct(start.cast("long").alias("start"), (start + F.length(m)).cast("long").alias("end"), m.alias("value"))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return df.withColumn(out, F.when(n > 0, F.transform("_m", span)).otherwise(empty)).drop("_m", "_p", "_g", "_b")


def upper_tail(z: Column) -> Column:
    """P(normal > z) for z >= 0: the density over a weighted mean of z and a root, within 0.3 % everywhere."""
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) / (0.661 * z + 0.339 * F.sqrt(z * z + 5.51))


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * upper_tail(F.abs(z)))


def encoding(value: Column) -> Column:
    out = F.lit(BOTH_CASES[-1])
    for alphabet in reversed(BOTH_CASES[:-1]):
        out = F.when(F.translate(value, alphabet, "") == "", F.lit(alphabet)).otherwise(out)
    for alphabet in reversed(ONE_CASE):
        out = F.when(F.translate(value, alphabet + SEPARATORS, "") == "", F.lit(alphabet)).otherwise(out)
    return out


def with_battery(spans: DataFrame, value: str = "value") -> DataFrame:
    """Add ``p_uniform``, the least p-value of the three tests of randomness, and ``p_text``."""
    df = spans.withColumn("_alphabet", encoding(F.col(value)))
    symbols = F.when(F.col("_alphabet").isin(ONE_CASE), F.translate(F.col(value), SEPARATORS, "")).otherwise(F.col(value))
    df = df.withColumn("_value", symbols).withColumn("_c", F.split(F.col("_value"), ""))
    df = df.withColumn("_v", F.transform("_c", lambda c: F.instr(F.col("_alphabet"), c) - 1))
    n, a = F.length("_value").cast("double"), F.length("_alphabet").cast("double")
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
    df = df.withColumn("_equal", total(F.transform(F.array_distinct("_c"), lambda c: F.pow(n - F.length(F.replace(F.col("_value"), c, F.lit(""))), F.lit(2)))))
    df = df.withColumn("_mean", total(F.transform("_v", lambda v: v.cast("double"))) / n)
    df = df.withColumn("_high", total(F.transform("_v", lambda v: (v * 2 >= a).cast("double"))))
    next_ = lambda x, f: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), f)
    df = df.withColumn("_runs", total(next_(F.col("_v"), lambda x, y: ((x * 2 >= a) != (y * 2 >= a)).cast("double"))) + 1)
    df = df.withColumn("_spread", total(F.transform("_v", lambda v: F.pow(v - F.col("_mean"), F.lit(2)))))
    df = df.withColumn("_serial", total(next_(F.col("_v"), lambda x, y: (x - F.col("_mean")) * (y - F.col("_mean")))))
    kind = lambda c: F.when(c.between("0", "9"), 0).when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).otherwise(3)
    df = df.withColumn("_changes", total(next_(F.transform("_c", kind), lambda x, y: (x != y).cast("double"))))

    k = a - 1
    chi = F.greatest(F.col("_equal") * a / n - n, F.lit(0.0))
    z_chi = (F.pow(chi / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    p_chi = F.when(z_chi > 0, upper_tail(z_chi)).otherwise(F.lit(1.0))
    both = 2 * F.col("_high") * (n - F.col("_high"))
    variance = both * (both - n) / (n * n * (n - 1))
    p_runs = F.when(variance > 0, two_sided((F.col("_runs") - both / n - 1) / F.sqrt(variance))).otherwise(F.lit(0.0))
    p_serial = F.when(F.col("_spread") > 0, two_sided((F.col("_serial") / F.col("_spread") + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))

    pairs, equal = n * (n - 1) / 2, (F.col("_equal") - n) / 2
    spread = F.sqrt(pairs * TEXT_EQUAL * (1 - TEXT_EQUAL) + n * (n - 1) * (n - 2) * (TEXT_TRIPLE - TEXT_EQUAL ** 2))
    z_equal = (pairs * TEXT_EQUAL - equal) / spread
    p_equal = F.when(z_equal > 0, upper_tail(z_equal)).otherwise(F.lit(1.0))
    rate = F.col("_changes") / (n - 1)
    odds = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - TEXT_CHANGE))).otherwise(F.lit(0.0))
    p_changes = F.when(rate > TEXT_CHANGE, F.exp(-(n - 1) * (rate * F.log(rate / TEXT_CHANGE) + odds))).otherwise(F.lit(1.0))
    return (df.withColumn("p_uniform", F.least(p_chi, p_runs, p_serial))
            .withColumn("p_text", F.least(F.lit(1.0), 2 * F.least(p_equal, p_changes)))
            .drop("_alphabet", "_value", "_c", "_v", "_equal", "_mean", "_high", "_runs", "_spread", "_serial", "_changes"))


def evidence(p_text: Column) -> Column:
    """-log10 p in whole bins, rounded down."""
    return F.least(F.floor(-F.log10(F.greatest(p_text, F.lit(1e-300))) / BIN), F.lit(MOST_BINS)).cast("int")


def threshold(candidates: DataFrame, false_share: float = FALSE_SHARE) -> int | None:
    """The least bin of evidence that Benjamini-Hochberg accepts, over all candidates; None if none is.

    ``candidates`` has a column ``bin``, null where a test found the candidate not uniform (p-value 1).
    At most MOST_BINS + 2 rows come to the driver.
    """
    rows = candidates.groupBy("bin").count().collect()
    tests, above, best = sum(r["count"] for r in rows), 0, None
    for r in sorted((r for r in rows if r.bin is not None), key=lambda r: -r.bin):
        above += r["count"]
        if tests * 10 ** (-r.bin * BIN) <= false_share * above:
            best = r.bin
    return best


def pattern_spans(spans: str, number: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """The spans whose match, or the group of it that counts, is long enough, with their kind."""
    long_ = F.filter(spans, lambda s: F.length(F.regexp_extract(s["value"], pattern, group)) >= least)
    return F.transform(long_, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def candidates(runs: DataFrame, base: DataFrame) -> DataFrame:
    """(_row, run, start, end, value), once each, of every run (_row, start, value) and its pieces that touch no span of ``base`` (_row, start, end).

    One sweep over a text: a span touches a candidate if it starts before the candidate's end and, of all such spans, the largest end is behind its start.
    """
    divided = F.when(F.translate("value", SEPARATORS, "") != F.col("value"), F.col("value"))  # null has no pieces
    df = runs.withColumn("_divided", divided)
    for i, pattern in enumerate(PIECES):
        df = with_spans(df, "_divided", pattern, f"_piece{i}")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length("value").cast("long").alias("end"), F.col("value").alias("value")))
    every = F.concat(whole, *(F.coalesce(f"_piece{i}", F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")) for i in range(len(PIECES))))
    df = df.select("_row", F.col("start").alias("run"), F.explode(every).alias("_c")).select(
        "_row", (F.col("run") + F.col("_c.end")).alias("_at"), F.lit(False).alias("_is_base"), "run",
        (F.col("run") + F.col("_c.start")).alias("start"), (F.col("run") + F.col("_c.end")).alias("end"), "_c.value")
    spans = base.select("_row", F.col("start").alias("_at"), F.lit(True).alias("_is_base"), F.lit(None).cast("long").alias("run"), "start", "end",
                        F.lit(None).cast("string").alias("value"))
    sweep = W.partitionBy("_row").orderBy("_at", "_is_base", "start")
    reach = F.max(F.when(F.col("_is_base"), F.col("end"))).over(sweep.rowsBetween(W.unboundedPreceding, -1))
    last = F.lag(F.struct("_at", "_is_base", "start")).over(sweep)
    df = df.unionByName(spans).withColumn("_touched", F.coalesce(reach > F.col("start"), F.lit(False)))
    df = df.withColumn("_again", F.coalesce(last == F.struct("_at", "_is_base", "start"), F.lit(False)))
    return df.where("not _is_base and not _touched and not _again").select("_row", "run", "start", "end", "value")


def best(spans: Column) -> Column:
    """Of spans that overlap, the first in order."""
    none = F.array().cast("array<struct<bin:int,size:bigint,start:bigint,end:bigint>>")
    over = lambda s, chosen: F.exists(chosen, lambda c: (c["start"] < s["end"]) & (s["start"] < c["end"]))
    return F.aggregate(F.array_sort(spans), none, lambda chosen, s: F.when(over(s, chosen), chosen).otherwise(F.concat(chosen, F.array(s))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE, carry: bool = False) -> DataFrame:
    """(id, spans array<struct<start, kind number, end, kind>>) of every row; with ``carry`` the row itself as ``_carried``.

    Kind numbers 0, 1, 2 are the patterns as listed, 3 what the battery added. Sorted by start, then kind.
    """
    carried = ["_carried"] if carry else []
    df = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *([whole_row(docs).alias("_carried")] if carry else []))
    spans = []
    for number, (kind, pattern, group, least) in enumerate(PATTERNS):
        df = with_spans(df, "_text", pattern, f"_{kind}")
        spans.append(pattern_spans(f"_{kind}", number, kind, pattern, group, least))
    df = with_spans(df, "_text", CANDIDATE, "_candidates").withColumn("_base", F.array_sort(F.concat(*spans)))
    runs = F.transform("_candidates", lambda c: F.struct(c["start"].alias("start"), c["value"].alias("value")))
    rows = df.select("_id", "_base", *carried, runs.alias("_runs")).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "secret-candidates")
    free = candidates(rows.select("_row", F.explode("_runs").alias("_c")).select("_row", "_c.start", "_c.value"),
                      rows.where(F.size("_runs") > 0).select("_row", F.explode("_base").alias("_b")).select("_row", "_b.start", "_b.end"))
    tested = with_battery(free)
    tested = materialize(tested.select("_row", "run", "start", "end", F.when(F.col("p_uniform") >= UNIFORM_P, evidence(F.col("p_text"))).alias("bin")), "secret-tests")
    least = threshold(tested, false_share)
    accepted = tested.where(F.col("bin") >= least if least is not None else F.lit(False))
    # of those that overlap, at first or last, the best ones: a group begins where none before reaches
    order = W.partitionBy("_row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    groups = accepted.withColumn("_first", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")).withColumn("_group", F.sum("_first").over(order))
    chosen = groups.groupBy("_row", "_group").agg(
        best(F.collect_list(F.struct((-F.col("bin")).alias("bin"), (F.col("start") - F.col("end")).alias("size"), "start", "end"))).alias("_best"))
    added = chosen.select("_row", F.explode("_best").alias("_b")).groupBy("_row").agg(
        F.collect_list(F.struct("_b.start", F.lit(3).alias("number"), "_b.end", F.lit("random").alias("kind"))).alias("_added"))  # of one document
    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint,kind:string>>")
    return rows.join(added, "_row", "left").select(
        F.col("_id").alias(id_col), *carried, F.array_sort(F.concat("_base", F.coalesce("_added", none))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; of overlapping spans the first covers what it reaches.

    Spans are taken in blocks of as many as there are blocks, so the whole text is read once a block, and a span reads its block's part alone.
    """
    n = F.size(spans)
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(n))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda b: F.slice(spans, b * block + 1, block))
    cut = lambda t, at, end: F.substring(t, (at + 1).cast("int"), F.greatest(end - at, F.lit(0)).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        between = cut(acc["part"], acc["at"] - acc["base"], s["start"] - acc["base"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], between, F.when(s["start"] >= acc["at"], F.lit(mark)).otherwise(F.lit(""))).alias("out"),
            s["end"].alias("at"), acc["base"].alias("base"), acc["part"].alias("part")))

    def block_step(acc: Column, some: Column) -> Column:
        part = cut(text, acc["at"], F.array_max(F.transform(some, lambda s: s["end"])))
        first = F.struct(F.lit("").alias("out"), acc["at"].alias("at"), acc["at"].alias("base"), part.alias("part"))
        done = F.aggregate(some, first, step, lambda x: F.struct(x["out"].alias("out"), x["at"].alias("at")))
        # one evaluation of ``done``: an array of one, taken apart
        return F.element_at(F.transform(F.array(done), lambda d: F.struct(F.concat(acc["out"], F.array(d["out"])).alias("out"), d["at"].alias("at"))), 1)

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))
    whole = F.aggregate(blocks, start, block_step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(n > 0, whole).otherwise(text)
