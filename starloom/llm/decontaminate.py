"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

Texts become templates: numbers, names (capitalised words inside a sentence) and units (after a
number) turn into typed placeholders, punctuation and case go. Windows of ``WINDOW`` template tokens
are hash-joined with the benchmark's. Matches on one diagonal (document position minus item
position) form a run; a run counts if it covers enough of the item and if its slots are consistent:
equal item values were replaced by equal document values and the other way round. So a question
with other numbers, names or units is caught, and a mere likeness of form is not.

Each text is read twice: names are capitalised words inside a sentence and 2.50 is two numbers, or names
are all capitalised words (neighbours make one name) and 2.50 is one. Raw tokens, whatever their case, are
a second key, so copies in another case are found.

Every token is hashed once; the hash of a window is put together from its tokens' when the windows of a
text are listed, so that what is listed meets the broadcast windows of the benchmark in the same step.

Windows with fewer than ``CONTENT`` tokens besides placeholders are matched by their raw tokens only,
so items of numbers or names are found where they were copied word for word. Shorter items than a window
form one window of their own length. Defined results: null and empty texts match nothing; very long
texts are read whole; repeated rows count once (one row per doc_id and item), ties of runs go to the
narrow reading and the first diagonal; rows with a null id are reported under a null id; an empty
benchmark or table matches nothing. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize

WINDOW = 8
CONTENT = 4
# A run must cover so many tokens, or all but two of a shorter item.
LEAST_RUN = 13
# A consistent part of a run whose slots contradict elsewhere must cover so many.
LEAST_PART = 2 * LEAST_RUN
# Rows of (hash, item, position) that are broadcast at most: about 20 MB.
BROADCAST_WINDOWS = 400_000

NAME, NUMBER, UNIT = "<name>", "<num>", "<unit>"
PLACEHOLDERS = [NAME, NUMBER, UNIT]
# Units after a number.
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi mile miles mg g gram grams kg lb lbs oz ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent mph kmh"
).split()
# In cleaned texts, before a name inside a sentence, before any other capitalised word, between digits
# of one number, and between the words of one name. (Control characters keep ASCII texts ASCII.)
_MARK, _OPEN, _JOIN, _AND = "\x01", "\x02", "\x03", "\x04"


def _cleaned(text: Column) -> Column:
    """Lower-case tokens separated by single spaces, with marks."""
    t = F.translate(text, _MARK + _OPEN + _JOIN + _AND, "    ")
    t = F.regexp_replace(t, r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N},;] )", _MARK)
    t = F.regexp_replace(t, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{N}}{_MARK}])", _OPEN)
    t = F.regexp_replace(t, rf"([{_MARK}{_OPEN}]\p{{L}}+) (?=[{_MARK}{_OPEN}])", "$1" + _AND)
    t = F.regexp_replace(t, r"[.,:/'\u2019\u00a0\u202f](?<=\p{N}.)(?=\p{N})", _JOIN)
    t = F.regexp_replace(t, r"(\p{N})(?=\p{L})", "$1 ")
    return F.trim(F.lower(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{_MARK}{_OPEN}{_JOIN}{_AND}]+", " ")))


def _template(cleaned: Column, name: str = _MARK, number: str = r"\p{N}+") -> Column:
    """Each token of ``cleaned`` as itself or its placeholder, in the same place."""
    t = F.regexp_replace(cleaned, rf"[{name}][^ ]*", NAME)
    t = F.regexp_replace(t, rf"(?<![^ ]){number}(?![^ ])", NUMBER)
    return F.regexp_replace(t, rf"(?<={NUMBER} )(?:{'|'.join(UNITS)})(?![^ ])", UNIT)


def _tokens(df: DataFrame, text: str) -> DataFrame:
    """Adds raw (values) and tpl (template), arrays of equal length, empty for an empty text; and, as
    wide_raw and wide_tpl, those in which neighbouring capitalised words are a name and 2.50 is one number."""
    empty = F.expr("CAST(array() AS array<string>)")
    parts = lambda c: F.when(c == "", empty).otherwise(F.split(c, " "))
    df = df.withColumn("__wide", _cleaned(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    df = df.withColumn("__clean", F.translate("__wide", _JOIN + _AND + _OPEN, "  "))
    df = df.withColumn("__tpl", _template(F.col("__clean"))).withColumn("__wide_tpl", _template(F.col("__wide"), _MARK + _OPEN, rf"\p{{N}}[\p{{N}}{_JOIN}]*"))
    df = df.withColumn("raw", parts(F.translate("__clean", _MARK, ""))).withColumn("tpl", parts(F.col("__tpl")))
    df = df.withColumn("wide_raw", parts(F.translate("__wide", _MARK + _OPEN, ""))).withColumn("wide_tpl", parts(F.col("__wide_tpl")))
    return df.drop("__wide", "__clean", "__tpl", "__wide_tpl")


def _views(df: DataFrame, *keep: str) -> DataFrame:
    """Two rows for each of ``_tokens``: raw and tpl, and with wide the others under these names."""
    narrow = F.struct(F.lit(False).alias("wide"), "raw", "tpl")
    wide = F.struct(F.lit(True).alias("wide"), F.col("wide_raw").alias("raw"), F.col("wide_tpl").alias("tpl"))
    return df.select(*keep, F.inline(F.array(narrow, wide)))


# What tells the windows of the wide reading from the others.
WIDE = 0x5DEECE66D1CE4E5B


def _token_hashes(tokens: str) -> Column:
    return F.transform(tokens, lambda x: F.xxhash64(x))


def _window_hash(hashes: str, place: Column, size: int) -> Column:
    """The hash of the ``size`` tokens from ``place`` on, which must be there. Each token's hash is shifted
    by its place, so order counts; the last still gives 43 bits. (Kept short: a long expression makes a
    method that the JVM does not compile.)"""
    h = F.get(hashes, place)
    for k in range(1, size):
        h = h.bitwiseXOR(F.shiftrightunsigned(F.get(hashes, place + k), 3 * k))
    return F.coalesce(h, F.lit(0).cast("long"))


def _listed(df: DataFrame, hashes: str, size: int, *keep: str) -> DataFrame:
    """(..., ipos, h): the windows of an array of token hashes."""
    rows = df.select(*keep, F.col(hashes).alias("__h"), F.posexplode_outer(hashes).alias("ipos", "__t"))
    return rows.where(F.col("ipos") + size <= F.size("__h")).select(*keep, "ipos", _window_hash("__h", F.col("ipos"), size).alias("h"))


def _key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")]


def _covers(windows: str) -> Column:
    """Tokens that a run's matching windows stand for."""
    return F.size(windows) + F.col("size").cast("int") - 1


def _slots(windows: Column, kinds: str) -> Column:
    """(place, kind, ours, theirs) of the placeholders under the windows; what lies between windows does not count."""
    places = F.array_distinct(F.flatten(F.transform(windows, lambda i: F.sequence(i, i + F.col("size") - 1))))
    cells = F.transform(
        places,
        lambda p: F.struct(
            p.alias("place"),
            F.get(F.col(kinds), p).alias("kind"),
            F.get(F.col("item_raw"), p).alias("ours"),
            F.get(F.col("raw"), F.col("diagonal") + p).alias("theirs"),
        ),
    )
    return F.filter(cells, lambda x: x["kind"].isin(PLACEHOLDERS))


def _leak(n_windows: Column, first: Column, slots: Column) -> Column:
    values = F.array_distinct(F.transform(slots, lambda x: F.struct(x["kind"], x["ours"], x["theirs"])))
    return F.struct(
        (n_windows + F.col("size").cast("int") - 1).alias("n_matched"),
        (F.col("diagonal") + first).cast("int").alias("doc_start"),
        F.size(values).alias("n_slots"),
    )


def _consistent_part() -> Column:
    """(n, first) of the part of the run ``__at`` with most windows in which no two of ``__slots`` contradict."""
    earlier = lambda y: F.filter(
        F.col("__slots"),
        lambda x: (x["place"] < y["place"]) & (x["kind"] == y["kind"]) & ((x["ours"] == y["ours"]) != (x["theirs"] == y["theirs"])),
    )
    cuts = F.transform("__slots", lambda y: F.struct(y["place"].alias("end"), F.array_max(F.transform(earlier(y), lambda x: x["place"])).alias("cut")))
    cuts = F.concat(F.filter(cuts, lambda x: x["cut"].isNotNull()), F.array(F.struct(F.lit(2**31 - 1).alias("end"), F.lit(2**31 - 2).alias("cut"))))
    start = F.struct(F.lit(0).alias("begin"), F.expr("CAST(array() AS array<struct<begin: int, end: int>>)").alias("parts"))
    parts = F.aggregate(
        cuts,
        start,
        lambda s, c: F.when(c["cut"] < s["begin"], s).otherwise(
            F.struct((c["cut"] + 1).alias("begin"), F.concat(s["parts"], F.array(F.struct(s["begin"].alias("begin"), c["end"].alias("end")))).alias("parts"))
        ),
        lambda s: s["parts"],
    )
    inside = lambda q: F.filter(F.col("__at"), lambda i: (i >= q["begin"]) & (i + F.col("size") <= q["end"]))
    return F.array_max(F.transform(parts, lambda q: F.struct(F.size(inside(q)).alias("n"), F.get(inside(q), F.lit(0)).alias("first"))))


def _readings(runs: DataFrame, *readings: str) -> DataFrame:
    """A column __leak... for each way to read a run, null where the run does not count by it: windows equal
    in raw tokens need no slots; windows equal by a template need consistent ones, over the whole run or,
    for LEAST_PART tokens, over a part."""
    size = F.col("size").cast("int")
    for r in readings:
        equal = lambda i: F.slice(f"item_{r}", i + 1, size) == F.slice(r, F.col("diagonal") + i + 1, size)  # noqa: E731, B023
        runs = runs.withColumn("__at", F.filter("at", equal)).withColumn("__slots", _slots(F.col("__at"), "item_tpl" if r == "raw" else f"item_{r}"))
        first = F.get("__at", F.lit(0))
        enough = (F.size("__at") > 0) & (_covers("__at") >= F.col("least"))
        if r == "raw":
            runs = runs.withColumn("__leak_raw", F.when(enough, _leak(F.size("__at"), first, F.col("__slots"))))
            continue
        count = lambda *own: F.size(F.array_distinct(F.transform("__slots", lambda x: F.struct(x["kind"], *(x[c] for c in own)))))
        same = (count("ours", "theirs") == count("ours")) & (count("ours", "theirs") == count("theirs"))
        runs = runs.withColumn("__same", same)
        runs = runs.withColumn(f"__leak_{r}", F.when(enough & F.col("__same"), _leak(F.size("__at"), first, F.col("__slots"))))
        runs = runs.withColumn("__part", F.when(~F.col("__same") & (_covers("__at") >= LEAST_PART), _consistent_part()))
        own = F.filter("__slots", lambda x: x["place"] >= F.col("__part.first"))
        long = (F.col("__part.n") > 0) & (F.col("__part.n") + size - 1 >= LEAST_PART)
        runs = runs.withColumn(f"__leak_{r}_part", F.when(long, _leak(F.col("__part.n"), F.col("__part.first"), own)))
    return runs


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, n_matched, n_item, doc_start, n_slots): the best run of each
    document and item that leaked."""
    items = _views(_tokens(benchmark.select("item_id", "text").distinct(), "text"), "item_id", "text")
    # Each of the two views of an item is an item until the end, where own is the same for both.
    items = items.withColumn("item", F.xxhash64("item_id", "text", "wide")).withColumn("own", F.xxhash64("item_id", "text"))
    items = materialize(items.select("item", "own", "wide", "item_id", "raw", "tpl", F.size("tpl").alias("n_item")), "decontam-items")
    sizes = sorted(
        r[0] for r in items.where("n_item > 0").select(F.least("n_item", F.lit(WINDOW)).alias("n")).distinct().collect()
    )  # at most WINDOW numbers

    hashed = items.withColumn("typed", _token_hashes("tpl")).withColumn("exact", _token_hashes("raw"))

    def item_windows(size: int) -> DataFrame:
        own = hashed.where(F.least("n_item", F.lit(WINDOW)) == size)
        content = F.size(F.filter(F.slice("tpl", F.col("ipos") + 1, size), lambda x: ~x.isin(PLACEHOLDERS)))
        typed = _listed(own, "typed", size, "item", "wide", "tpl").where(content >= CONTENT)
        typed = typed.withColumn("h", F.when(F.col("wide"), F.col("h").bitwiseXOR(F.lit(WIDE))).otherwise(F.col("h")))
        exact = _listed(own.where("NOT wide"), "exact", size, "item", "wide")
        return typed.select("item", "ipos", "h").unionByName(exact.select("item", "ipos", "h")).distinct().withColumn("size", F.lit(size))

    rows = docs.select(*_key(), "text")
    # One array a text: the hashes of the template, of the raw tokens unless they are alike, of the wide
    # template; n and m are where the second and the third begin.
    alike = F.col("tpl") == F.col("raw")
    none = F.expr("CAST(array() AS array<bigint>)")
    tokenised = _tokens(rows, "text").select(
        "doc_id",
        "text_hash",
        F.size("tpl").alias("n"),
        F.when(alike, F.size("tpl")).otherwise(2 * F.size("tpl")).alias("m"),
        F.concat(_token_hashes("tpl"), F.when(alike, none).otherwise(_token_hashes("raw")), _token_hashes("wide_tpl")).alias("hashes"),
    )
    schema = "doc_id long, text_hash long, item_id long, n_matched int, n_item int, doc_start int, n_slots int"
    if not sizes:
        return docs.sparkSession.createDataFrame([], schema)
    own = reduce(DataFrame.unionByName, [item_windows(size) for size in sizes])
    own = materialize(own.withColumn("h", F.col("h").bitwiseXOR(F.col("size").cast("long"))), "decontam-windows")
    small = own.count() <= BROADCAST_WINDOWS
    # Windows are put together after the tokens are listed, by plain arithmetic in compiled code; a lambda
    # over windows would be interpreted. All sizes are made from one reading of the texts. (The outer form
    # of explode: for the other the optimizer infers a filter on the array's size and pushes it, and with
    # it all that makes the array, below the projections, where it is computed once more for each mention.)
    seen = tokenised.select("doc_id", "text_hash", "n", "m", "hashes", F.posexplode_outer("hashes").alias("place", "__t"))
    first, second = F.col("place") < F.col("n"), F.col("place") < F.col("m")
    begin = F.when(first, 0).when(second, F.col("n")).otherwise(F.col("m"))
    end = F.when(first, F.col("n")).when(second, F.col("m")).otherwise(F.size("hashes"))
    seen = seen.where(F.col("place") + sizes[0] <= end)
    salt = F.when(second, F.lit(0).cast("long")).otherwise(F.lit(WIDE))
    hs = [_window_hash("hashes", F.col("place"), n).bitwiseXOR(salt).bitwiseXOR(F.lit(n).cast("long")) for n in sizes]
    if len(sizes) > 1:  # short items too
        fits = [F.when(F.col("place") + n <= end, h) for n, h in zip(sizes, hs, strict=True)]
        h = F.explode(F.array(*fits)).alias("h")
    else:
        h = hs[0].alias("h")
    seen = seen.select("doc_id", "text_hash", h, (F.col("place") - begin).alias("pos"))
    found = seen.join(F.broadcast(own) if small else own, "h").select("doc_id", "text_hash", "item", "size", "pos", "ipos")

    # Runs by diagonal; copies of a row count once (equal keys give equal positions).
    runs = (
        found.groupBy("doc_id", "text_hash", "item", (F.col("pos") - F.col("ipos")).alias("diagonal"))
        .agg(F.array_sort(F.collect_set("ipos")).alias("at"), F.max("size").alias("size"))
        .join(items.select("item", "own", "wide", "item_id", "n_item", F.col("raw").alias("item_raw"), F.col("tpl").alias("item_tpl")), "item")
        .withColumn("least", F.least(F.lit(LEAST_RUN), F.greatest(F.col("n_item") - 2, F.lit(1))))
        .where(_covers("at") >= F.col("least"))
    )
    runs = materialize(runs, "decontam-runs")
    wanted = runs.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    leaked = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")), "left_semi")
    leaked = leaked.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    texts = _views(_tokens(leaked, "text"), "doc_id", "text_hash").select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), F.col("wide").alias("__w"), "raw", "tpl"
    )
    runs = runs.join(texts, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")) & (F.col("wide") == F.col("__w")))

    runs = _readings(runs, "raw", "tpl")
    options = F.array_compact(F.array(*(F.col(c) for c in runs.columns if c.startswith("__leak"))))
    runs = runs.withColumn("leak", F.array_max(options)).where("leak IS NOT NULL")
    best = F.max_by(F.struct("leak", "n_item"), F.struct("leak.n_matched", ~F.col("wide"), -F.col("diagonal")))
    kept = runs.groupBy("doc_id", "text_hash", "own", "item_id").agg(best.alias("b"))
    return kept.select("doc_id", "text_hash", "item_id", "b.leak.n_matched", "b.n_item", "b.leak.doc_start", "b.leak.n_slots")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leaked benchmark item."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    bad = materialize(bad, "decontam-leaked")
    keyed = docs.withColumn("__h", _key()[1])
    return keyed.join(
        bad, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__h") == F.col("__t")), "left_anti"
    ).drop("__h")
