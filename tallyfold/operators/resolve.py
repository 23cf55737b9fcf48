"""Entity resolution: cascaded exact and fuzzy tiers, duplicates, first mappable venue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalars import uuid5

#: The URL-independent DNS namespace of RFC 4122.
NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
FUZZY_LEAST = 0.90


#: Edits up to which names are paired by their forms with that many characters left out; a name of 29 characters has 436 of them.
DELETED = 2


def _sorted(side: DataFrame) -> DataFrame:
    """side, to be joined by sorting. Spark judges a table by its file, and a name in a file of a few MB has twenty forms and more, all of which a broadcast would send through the driver."""
    return side.hint("merge")


def _shortened(name: str, edits: str) -> F.Column:
    """Distinct forms of a name with up to edits (0 to DELETED) characters left out."""
    without = lambda s: f"transform(sequence(1, length({s})), _i -> concat(left({s}, _i - 1), substr({s}, _i + 1)))"
    one = without(name)
    two = f"flatten(transform({one}, _s -> if(_s = '', array(_s), {without('_s').replace('_i', '_j')})))"
    return F.expr(f"array_distinct(CASE {edits} WHEN 0 THEN array({name}) WHEN 1 THEN concat(array({name}), {one}) ELSE concat(array({name}), {one}, {two}) END)")


def _near_short(xs: DataFrame, ys: DataFrame) -> DataFrame:
    """Candidates whose longer name allows at most DELETED edits: names that many edits apart have a form in common, however much of their text all names share.

    A pair belongs to the edits of its longer name, a tenth of its length. A name can be the shorter one of a pair that allows one edit more; the characters
    that it lacks there are edits already, so it leaves out fewer.
    """
    def forms(names: DataFrame, name: str) -> DataFrame:
        k = f"CAST(length({name}) DIV 10 AS INT)"
        edits = F.explode(F.expr(f"IF(length({name}) + {k} + 1 >= 10 * ({k} + 1), array({k}, {k} + 1), array({k}))"))
        sized = names.select("country", name, edits.alias("edits")).filter(F.col("edits") <= DELETED).withColumn("out", F.expr(f"edits - greatest(0, 10 * edits - length({name}))"))
        return sized.select("country", name, "edits", F.explode(_shortened(name, "out")).alias("form")).select("country", name, "edits", F.xxhash64("form").alias("form"))

    return forms(xs, "x").join(_sorted(forms(ys, "y")), ["country", "edits", "form"]).select("x", "y", "country")


def _near_long(xs: DataFrame, ys: DataFrame) -> DataFrame:
    """Candidates whose longer name allows more edits than DELETED.

    Within a tenth of the longer length, y has at most len(y) div 9 edits, so of one piece more than that at least one is in x unchanged, moved by no
    more places than there are edits. Pieces that most names of a country share make most of its pairs candidates.
    """
    shortest = 10 * (DELETED + 1)
    cut = {"start": F.expr("CAST(i * y_len DIV (y_len DIV 9 + 1) AS INT)"), "size": F.expr("CAST((i + 1) * y_len DIV (y_len DIV 9 + 1) - i * y_len DIV (y_len DIV 9 + 1) AS INT)")}
    pieces = F.explode(F.expr("sequence(0, CAST(y_len DIV 9 AS INT))"))
    # The longer name has the shortest length at least, the other one nine tenths of it.
    y = ys.withColumn("y_len", F.length("y")).filter(F.col("y_len") >= shortest - shortest // 10).withColumn("i", pieces).withColumns(cut)
    y = y.select("country", "y_len", "i", "y", F.expr("substring(y, start + 1, size)").alias("piece"))
    x = xs.withColumn("x_len", F.length("x")).filter(F.col("x_len") >= shortest - shortest // 10)
    x = x.withColumn("y_len", F.explode(F.expr("sequence(CAST(x_len - x_len DIV 10 AS INT), CAST(10 * x_len DIV 9 AS INT))"))).filter(F.greatest("x_len", "y_len") >= shortest).withColumn("i", pieces).withColumns(cut)
    x = x.withColumn("most", F.expr("CAST(greatest(x_len, y_len) DIV 10 AS INT)")).withColumn("at", F.explode(F.expr("sequence(start - most, start + most)")))
    x = x.filter("at >= 0 AND at + size <= x_len").select("country", "y_len", "i", "x", F.expr("substring(x, at + 1, size)").alias("piece")).distinct()
    return x.join(_sorted(y), ["country", "y_len", "i", "piece"]).select("x", "y", "country")


def near_names(xs: DataFrame, ys: DataFrame) -> DataFrame:
    """xs(x, country), ys(y, country): all (x, y, country) of at least FUZZY_LEAST Levenshtein similarity by the longer name, each once."""
    x, y = xs.filter("x <> ''").distinct(), ys.filter("y <> ''").distinct()
    score = 1 - F.levenshtein("x", "y") / F.greatest(F.length("x"), F.length("y"))
    return _near_short(x, y).unionByName(_near_long(x, y)).filter(score >= FUZZY_LEAST).select("x", "y", "country").distinct()


def cascade(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted(id, tax_id, name, country), known(entity, tax_id, name, country): (id, entity, tier).

    Tiers: tax id, then name and country, then the only candidate of at least 0.90 name similarity in the country, else a new id made from country and
    name. A fuzzy tier with two candidates is no match.
    """
    clean = lambda c: F.upper(F.trim(F.col(c)))
    w = wanted.select("id", F.col("tax_id").alias("w_tax"), clean("name").alias("w_name"), F.col("country").alias("w_country"))
    k = known.select("entity", F.col("tax_id").alias("k_tax"), clean("name").alias("k_name"), F.col("country").alias("k_country"))
    by_tax = k.filter("k_tax IS NOT NULL").groupBy("k_tax").agg(F.min("entity").alias("by_tax"))
    by_name = k.groupBy("k_name", "k_country").agg(F.min("entity").alias("by_name"))
    out = w.join(_sorted(by_tax), w.w_tax == by_tax.k_tax, "left").drop("k_tax")
    out = out.join(_sorted(by_name), (out.w_name == by_name.k_name) & (out.w_country == by_name.k_country), "left").drop("k_name", "k_country")
    open_rows = out.filter("by_tax IS NULL AND by_name IS NULL").select("id", "w_name", "w_country")
    near = near_names(open_rows.select(F.col("w_name").alias("x"), F.col("w_country").alias("country")), k.select(F.col("k_name").alias("y"), F.col("k_country").alias("country")))
    found = near.join(_sorted(k), (F.col("y") == F.col("k_name")) & (F.col("country") == F.col("k_country"))).groupBy("x", "country").agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("fuzzy")).filter("n = 1")
    fuzzy = open_rows.join(_sorted(found), (F.col("w_name") == F.col("x")) & (F.col("w_country") == F.col("country"))).select("id", "fuzzy")
    out = out.join(_sorted(fuzzy), "id", "left")
    minted = uuid5(NAMESPACE, F.concat_ws(":", "w_country", "w_name"))
    tier = F.when(F.col("by_tax").isNotNull(), "tax").when(F.col("by_name").isNotNull(), "name").when(F.col("fuzzy").isNotNull(), "fuzzy").otherwise("minted")
    return out.select("id", F.coalesce(F.col("by_tax").cast("string"), F.col("by_name").cast("string"), F.col("fuzzy").cast("string"), minted).alias("entity"), tier.alias("tier"))


def duplicate_pairs(entities: DataFrame, key: str, *on: str) -> DataFrame:
    """(kept, dropped): each entity with the smallest one of its group; a group of n gives n - 1 rows."""
    rows = entities.filter(" AND ".join(f"{c} IS NOT NULL" for c in on))
    least = rows.groupBy(*on).agg(F.min(key).alias("kept"))
    return rows.join(least, list(on)).select("kept", F.col(key).alias("dropped"), *on).filter("kept < dropped")


def first_choice(candidates: DataFrame, key: str, *order) -> DataFrame:
    """The best candidate per key."""
    return candidates.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")
