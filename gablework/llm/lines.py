"""Line deduplication by a segment-partition edit join, with DataFrame functions alone.

In order of (doc_id, place), a line is dropped if an earlier line is equal to it or, from MIN_CHARS on, within THRESHOLD
edits of it. Lines are cut into threshold + 1 segments: two lines within the threshold share one segment, at places that the
lengths and the segment's number narrow down. So each distinct line is indexed by its segments and its own length, probes
the substrings that could be a segment of a line of its length or a little shorter, and pairs that meet are verified by
bit-parallel edit distance in a band of 2 * threshold + 1 diagonals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.common import Scratch

#: Edits, and the length from which near lines count as one: an edit changes the meaning of a shorter line (a number, a heading) too
#: easily. Both are parameters; from 0 on all lines are compared.
THRESHOLD, MIN_CHARS = 1, 24
#: Keys with more distinct lines than this are crowded: their lines meet by finer keys instead.
CROWD = 32
#: Documents (24 bytes each) that hold a candidate line are broadcast up to this number, and joined by a shuffle beyond.
BROADCAST_ROWS = 200_000


def segments(length: Column, threshold: int) -> list[tuple[Column, Column]]:
    """Start (from 0) and length of each of threshold + 1 segments of nearly equal length, the longer ones last."""
    k = threshold + 1
    base, longer = F.floor(length / k).cast("int"), (length % k).cast("int")
    return [(i * base + F.greatest(F.lit(0), i - k + longer), base + F.when(i - k + longer >= 0, 1).otherwise(0)) for i in range(k)]


def _key(number: int, length: Column, part: Column) -> Column:
    return F.xxhash64(F.lit(number), length.cast("int"), part)


def _indexed(line: Column, length: Column, threshold: int) -> list[tuple[Column, Column, Column]]:
    """Key, start and length of each segment."""
    return [(_key(i, length, F.substring(line, start + 1, size)), start, size) for i, (start, size) in enumerate(segments(length, threshold))]


def _probed(line: Column, length: Column, threshold: int, least: int) -> list[tuple[Column, Column, Column, Column]]:
    """Whether there is one, key, start and length of the substrings that can be a segment of a line of length to length -
    threshold, least at least. Segment i may be shifted by i at most, counted from the left, and by threshold - i, counted
    from the right."""
    out = []
    for shorter in range(threshold + 1):
        own = length - shorter
        for i, (start, size) in enumerate(segments(own, threshold)):
            for shift in range(-threshold, threshold + 1):
                if max(-i, shorter - (threshold - i)) <= shift <= min(i, shorter + threshold - i):
                    at = start + shift
                    out.append(((own >= least) & (at >= 0) & (at + size <= length), _key(i, own, F.substring(line, at + 1, size)), at, size))
    return out


def index_keys(line: Column, length: Column, threshold: int) -> Column:
    return F.array(*(key for key, _, _ in _indexed(line, length, threshold)))


def probe_keys(line: Column, length: Column, threshold: int, min_chars: int) -> Column:
    return F.array_compact(F.array(*(F.when(fits, key) for fits, key, _, _ in _probed(line, length, threshold, min_chars))))


def _finer(rows: DataFrame, threshold: int, least: int) -> DataFrame:
    """Rows (node, place, kind, key, rest) by the segments of what is left of their lines, which goes on without the segment. Two
    lines that share a segment are within the threshold only if what is left of them is."""
    length = F.length("rest")
    without = lambda start, size: F.concat(F.substring(F.col("rest"), F.lit(1), start), F.substring(F.col("rest"), start + size + 1, length))
    item = lambda fits, key, start, size: F.when(fits & (size > 0), F.struct(F.xxhash64("key", key).alias("key"), without(start, size).alias("rest")))
    index = [item((F.col("kind") == 0) & (length >= least), *x) for x in _indexed(F.col("rest"), length, threshold)]
    probe = [item((F.col("kind") == 1) & x[0], *x[1:]) for x in _probed(F.col("rest"), length, threshold, least)]
    return rows.select("node", "place", "kind", F.inline(F.array_compact(F.array(*index, *probe))))


def _met(index: DataFrame, probe: DataFrame) -> DataFrame:
    met = index.select("node", "key").join(probe.select(F.col("node").alias("g1"), "key"), "key").where(F.col("node") != F.col("g1"))
    return met.select(F.least("node", "g1").alias("a"), F.greatest("node", "g1").alias("b"))


def _crowded(texts: DataFrame, keys: DataFrame, threshold: int, min_chars: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of lines (node, place, line) that share a key with many others, and links that are verified already.

    A crowded key's lines are dealt by the segments of what is left of them, again and again, until no key is crowded. Lines of
    which no more than threshold characters are left are checked against the first of them, and those that are not near it
    (what was taken out may have stood at shifted places) are paired with all others there. Segments of such a rest may be
    empty, so it also meets the rests of up to twice the threshold that are within the threshold of it."""
    start = texts.select("node", "place", F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"), F.lit(0).cast("long").alias("key"), F.col("line").alias("rest"))
    rows = _finer(start, threshold, min_chars)
    keys = keys.select(F.xxhash64(F.lit(0).cast("long"), "key").alias("key"))
    # A key names its whole path, so the rows of all levels are joined at once in the end.
    indexed, probed, ended = [], [], []
    while keys.limit(1).count():
        crowd = rows.join(keys, "key", "left_semi")
        ended.append(crowd.where(F.length("rest") <= 2 * threshold).select("key", "node", "place", "kind", "rest"))
        rows = scratch.table(_finer(crowd.where((F.col("kind") == 0) | (F.length("rest") > threshold)), threshold, 1), "crowded-lines")
        index = rows.where("kind = 0").select("node", "key")
        keys = scratch.table(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key"), "crowded-keys")
        indexed.append(index.join(keys, "key", "left_anti"))
        probed.append(rows.where("kind = 1").select("node", "key"))
    pairs = _met(reduce(DataFrame.union, indexed), reduce(DataFrame.union, probed)).distinct()
    # Those of which hardly anything is left.
    ends = scratch.table(reduce(DataFrame.union, ended).distinct(), "crowded-ends")
    few = ends.where(F.length("rest") <= threshold)
    short = few.select("key", "node", "place").distinct()
    first = short.groupBy("key").agg(F.min_by("node", "place").alias("f1"))
    line = lambda name: texts.select(F.col("node").alias(name), F.col("line").alias(f"{name}_line"))
    checked = short.join(first, "key").where(F.col("node") != F.col("f1")).join(line("node"), "node").join(line("f1"), "f1")
    checked = scratch.table(checked.select("key", "node", "f1", within(F.col("node_line"), F.col("f1_line"), threshold).alias("near")), "crowded-links")
    pair = (F.least("node", "g1").alias("a"), F.greatest("node", "g1").alias("b"))
    links = checked.where("near").select("node", F.col("f1").alias("g1")).select(*pair).distinct()
    others = checked.where("not near").select("key", "node").join(short.select("key", F.col("node").alias("g1")), "key")
    wide = ends.where((F.col("kind") == 1) & (F.length("rest") > threshold)).select("key", F.col("node").alias("g1"), F.col("rest").alias("more"))
    wide = few.where("kind = 0").join(wide, "key").where(F.levenshtein("rest", "more") <= threshold).select("key", "node", "g1")
    pairs = pairs.union(others.union(wide).where(F.col("node") != F.col("g1")).select(*pair)).distinct()
    return pairs, links


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance of two texts is at most threshold (30 at most): bit-parallel over the band of diagonals
    around the main one, a step for each character of b, as a fold over arrays of characters.

    Bit i of a vector stands for row j - threshold + i in the table's column j. The distance at the band's lower end is
    followed down the diagonal to the last row, then along that row."""
    if not 0 <= threshold <= 30:
        raise ValueError("threshold must be from 0 to 30")
    band = 2 * threshold + 1
    mask = (1 << band) - 1
    start = F.struct(F.lit(mask ^ ((1 << threshold) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(threshold).alias("d"))

    def walk(z: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(z["columns"])), start, lambda x, j: whole(x, j, z), lambda x: x["d"])

    def step(x: Column, j: Column, z: Column) -> Column:
        here = F.get(z["columns"], j - 1)
        same = reduce(lambda p, q: p.bitwiseOR(q), (F.when(F.get(z["rows"], j - 1 - threshold + i) == here, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(band)))
        return F.struct(same.alias("same"), x["vp"].alias("vp"), x["vn"].alias("vn"), x["d"].alias("d"), j.alias("j"))

    def first(x: Column) -> Column:
        d0 = ((x["same"].bitwiseAND(x["vp"]) + x["vp"]).bitwiseXOR(x["vp"])).bitwiseOR(x["same"]).bitwiseOR(x["vn"]).bitwiseAND(F.lit(mask).cast("long"))
        return F.struct(d0.alias("d0"), x["vp"].alias("vp"), x["vn"].alias("vn"), x["d"].alias("d"), x["j"].alias("j"))

    def second(x: Column) -> Column:
        hp = x["vn"].bitwiseOR(F.lit(mask).cast("long").bitwiseXOR(x["d0"].bitwiseOR(x["vp"])))
        hn = x["d0"].bitwiseAND(x["vp"])
        return F.struct(x["d0"].alias("d0"), hp.alias("hp"), hn.alias("hn"), x["d"].alias("d"), x["j"].alias("j"))

    def third(x: Column, m: Column) -> Column:
        down = F.shiftright(x["d0"], 1)
        vp = x["hn"].bitwiseOR(F.lit(mask).cast("long").bitwiseXOR(down.bitwiseOR(x["hp"])))
        vn = down.bitwiseAND(x["hp"])
        diagonal = F.when(x["d0"].bitwiseAND(F.lit(1 << band - 1).cast("long")) == 0, 1).otherwise(0)
        bit = _power(m - x["j"] + threshold, band)
        along = F.when(x["hp"].bitwiseAND(bit) != 0, 1).when(x["hn"].bitwiseAND(bit) != 0, -1).otherwise(0)
        return F.struct(vp.alias("vp"), vn.alias("vn"), (x["d"] + F.when(x["j"] + threshold <= m, diagonal).otherwise(along)).cast("int").alias("d"))

    def whole(x: Column, j: Column, z: Column) -> Column:
        # A value named once is computed once: each part is applied to an array of one element.
        value = F.array(step(x, j, z))
        for part in (first, second, lambda y: third(y, F.size(z["rows"]))):
            value = F.transform(value, part)
        return F.element_at(value, 1)

    # So are the characters of both texts, which each step reads in constant time.
    texts = F.array(F.struct(F.split(a, "").alias("rows"), F.split(b, "").alias("columns")))
    m, n = F.length(a), F.length(b)
    # A text no longer than the band starts with the last row inside it.
    short = (m <= threshold) | (n <= threshold)
    return F.when(F.abs(m - n) > threshold, False).when(short, F.levenshtein(a, b) <= threshold).otherwise(F.element_at(F.transform(texts, walk), 1) <= threshold)


def _power(exponent: Column, band: int) -> Column:
    return F.element_at(F.array(*(F.lit(1 << i).cast("long") for i in range(band))), F.least(F.greatest(exponent, F.lit(0)), F.lit(band - 1)).cast("int") + 1)


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with its place: doc_id, t (a hash of the text, which tells rows of one doc_id apart), pos, line."""
    return docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


_H = (F.xxhash64, lambda c: F.xxhash64(F.lit("second"), c))


def _blank(line: str = "line") -> Column:
    return F.col(line).rlike(r"^\s*$")


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their text reduced to the lines that stay, and n_lines, n_dropped and n_near (lines that were
    dropped for a line that is not equal).

    Blank lines always stay. A null text stays null and has no lines. Rows equal in doc_id and text count as one row and
    are reduced alike; a null doc_id comes before all others. Other columns are kept, but for columns of these three
    names, which are replaced. An empty table gives none."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "n_near")]
    # Other columns go along as one, so that no name of theirs is in the way.
    docs = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    lines = _lines(docs.select("doc_id", "text"))
    full = lines.where(~_blank()).withColumn("length", F.length("line"))
    place = F.struct("doc_id", "t", "pos")
    none = F.array().cast("array<bigint>")
    keyed = full.select(
        *(h("line").alias(f"h{k + 1}") for k, h in enumerate(_H)), place.alias("place"),
        F.when(F.col("length") >= min_chars, index_keys(F.col("line"), F.col("length"), threshold)).otherwise(none).alias("index"),
        F.when(F.col("length") >= min_chars, probe_keys(F.col("line"), F.col("length"), threshold, min_chars)).otherwise(none).alias("probe"),
    )
    # One row for each distinct line, with its first place; lines are told apart by both hashes, then go by their row's number.
    scratch = Scratch(docs.sparkSession)
    lone = scratch.table(keyed.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("index").alias("index"), F.first("probe").alias("probe")).withColumn("node", F.monotonically_increasing_id()), "lines")
    index, probe = (lone.select("node", F.explode(k).alias("key")) for k in ("index", "probe"))
    crowds = scratch.table(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key"), "crowded-keys")
    crowded = crowds.limit(1).count() > 0
    own = index.join(crowds, "key", "left_anti") if crowded else index
    pairs = scratch.table(_met(own, probe).distinct(), "line-pairs")
    # Texts of the lines in a pair or under a crowded key, from their first places.
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    if crowded:
        wanted = wanted.union(index.union(probe).join(crowds, "key", "left_semi").select("node"))
    held = scratch.table(lone.select("h1", "h2", "node", "place").join(wanted.distinct(), "node", "left_semi"), "pair-lines")
    holders = held.select(F.col("place.doc_id").alias("of"), F.col("place.t").alias("t")).distinct()
    if holders.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        holders = F.broadcast(holders)
    source = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(holders, F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("t")), "left_semi")
    texts = scratch.table(full_lines(source).dropDuplicates(["h1", "h2"]).join(held, ["h1", "h2"]).select("node", "place", "line"), "pair-texts")
    sure = None
    if crowded:
        more, sure = _crowded(texts, crowds, threshold, min_chars, scratch)
        pairs = pairs.union(more).distinct()
    side = lambda name: texts.select(F.col("node").alias(name), F.col("line").alias(f"{name}_line"))
    links = pairs.join(side("a"), "a").join(side("b"), "b").where(within(F.col("a_line"), F.col("b_line"), threshold)).select("a", "b")
    links = links.union(sure) if sure is not None else links
    # The later line of a link is dropped wherever it stands.
    at = lambda name: held.select(F.col("node").alias(name), F.col("place").alias(f"{name}_place"))
    near = links.join(at("a"), "a").join(at("b"), "b").select(F.when(F.col("a_place") < F.col("b_place"), F.col("b")).otherwise(F.col("a")).alias("node")).distinct()
    near = scratch.table(near.withColumn("near", F.lit(True)), "near-lines")
    firsts = lone.select("h1", "h2", "node", F.col("place").alias("first")).join(near, "node", "left").drop("node")
    every = lines.select("doc_id", "t", "pos", _blank().alias("blank"), *(h("line").alias(f"h{k + 1}") for k, h in enumerate(_H)))
    judged = every.where("not blank").join(firsts, ["h1", "h2"])
    first = F.col("first") == place
    drop = ~first | F.coalesce("near", F.lit(False))
    marks = judged.select("doc_id", "t", "pos", drop.alias("drop"), (first & drop).alias("near")).union(every.where("blank").select("doc_id", "t", "pos", F.lit(False), F.lit(False)))
    marks = marks.groupBy(F.col("doc_id").alias("of"), F.col("t").alias("of_t")).agg(F.array_sort(F.collect_set(F.struct("pos", "drop", "near"))).alias("_marks"))
    joined = docs.withColumn("_t", F.xxhash64("text")).join(marks, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("_t") == F.col("of_t")) & F.col("text").isNotNull(), "left")
    stays = F.filter(F.split("text", "\n"), lambda x, i: ~F.get("_marks", i)["drop"])
    count = lambda name: F.coalesce(F.size(F.filter("_marks", lambda x: x[name])), F.lit(0))
    columns = [F.array_join(stays, "\n").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in names]
    sizes = [F.when(F.col("_marks").isNull(), 0).otherwise(F.size("_marks")).alias("n_lines")]
    sizes += [F.when(F.col("_marks").isNull(), 0).otherwise(count(k)).alias(v) for k, v in (("drop", "n_dropped"), ("near", "n_near"))]
    scratch.drop(lone, near)
    return joined.select(*columns, *sizes)


def full_lines(docs: DataFrame) -> DataFrame:
    """Lines that are not blank, by their hashes."""
    return _lines(docs).where(~_blank()).select(*(h("line").alias(f"h{k + 1}") for k, h in enumerate(_H)), "line")
