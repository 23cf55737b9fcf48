"""Matching by contained titles and aliases, duplicate decisions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import identifiers as I
from tallyfold.sources.scratch import kept

#: Fixed value: days that an answer's date and the register's may differ.
DAYS_APART = 45
#: Words of the runs that needles are looked up by.
RUNS = (1, 2, 4, 8)


def _probed(needles: DataFrame, hay: DataFrame, parts: str) -> DataFrame:
    """needles(n_id, <parts>) and hay(h_id, <parts>) as pairs that share the needle's rarest part.

    A needle contained in a text shares all its parts with it, so also the one that the fewest texts have. One key per needle: no pair is made of
    frequent parts, unless a needle has nothing else. A needle with a part that no text has finds nothing and goes.
    """
    return _met(needles.select("n_id", F.explode(parts).alias("part")), hay.select("h_id", F.explode(parts).alias("part")))


def _met(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """wanted(n_id, part), held(h_id, part) as pairs that share the needle's rarest part."""
    held = held.join(wanted.select("part").distinct(), "part", "left_semi")
    known = held.groupBy("part").agg(F.count("*").alias("n"))
    rare = wanted.join(known, "part", "left").groupBy("n_id").agg(F.min_by("part", F.struct(F.coalesce("n", F.lit(0)), "part")).alias("part"))
    return rare.join(held, "part").select("n_id", "h_id")


def _grams(x, size: int):
    """Distinct runs of size characters; a shorter text has none."""
    return F.when(F.length(x) >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - size + 1), lambda i: F.substring(x, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def _runs(rows: DataFrame, key: str, size: int) -> DataFrame:
    """rows(key, words): (key, part), a hash for each run of size words; fewer words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            words = batch.column("words")
            coded = pc.dictionary_encode(words.flatten())
            h = np.array([xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)[coded.indices.to_numpy()]
            owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
            n = len(h) - size + 1
            if n < 1:
                continue
            part = np.zeros(n, dtype=np.uint64)
            for k in range(size):
                part = part * np.uint64(0x9E3779B97F4A7C15) + h[k : n + k]
            whole = owner[:n] == owner[size - 1 :]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(owner[:n][whole])), pa.array(part[whole].view(np.int64))], [key, "part"])

    rows = rows.select(key, "words")
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, part long")


def contained(needles: DataFrame, hay: DataFrame, size: int = 3) -> DataFrame:
    """needles(n_id, text), hay(h_id, text): distinct (n_id, h_id) where the normal text of the needle is a part of the other's; empty needles find nothing.

    The inner words of a needle of three words or more are whole words of the text, in that order, so the rarest run of them, of up to eight words, finds the candidates. The ends of a needle may be
    parts of words: shorter needles go by their longest word, looked up by runs of up to size characters in the vocabulary first. Candidates are confirmed on
    the texts.
    """
    n = kept(needles.select("n_id", I.normal_text(F.col("text")).alias("t")).filter("t <> ''").withColumn("words", F.split("t", " ")), "needles")
    # Words are written too: an expression over all places of a text would cut it anew for each.
    h = kept(hay.select("h_id", I.normal_text(F.col("text")).alias("t")).withColumn("words", F.split("t", " ")), "hay")
    words = h.select("h_id", F.array_distinct("words").alias("parts"))
    # Runs as long as the needle has, of RUNS: a run of words is far rarer than any one of them.
    inner = n.filter(F.size("words") > 2).select("n_id", F.expr("slice(words, 2, size(words) - 2)").alias("words"))
    longest = F.lit(1)
    for k in RUNS:
        longest = F.when(F.size("words") >= k, F.lit(k)).otherwise(longest)
    inner = inner.withColumn("run", longest)
    pairs = None
    for k in sorted(r["run"] for r in inner.select("run").distinct().collect()):  # at most as many numbers as RUNS
        held = _runs(h, "h_id", k)
        wanted = kept(_runs(inner.filter(F.col("run") == k), "n_id", k).distinct(), "wanted")
        held = kept(held.join(wanted.select("part").distinct(), "part", "left_semi"), "held")
        found = _met(wanted, held)
        pairs = found if pairs is None else pairs.unionByName(found)
    if n.filter(F.size("words") <= 2).limit(1).count() == 0:
        return _confirmed(pairs, n, h) if pairs is not None else n.select("n_id").crossJoin(h.select("h_id").limit(0))
    short = n.filter(F.size("words") <= 2).select("n_id", F.array_max(F.transform("words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"].alias("w"))
    held = words.select("h_id", F.explode("parts").alias("word"))
    vocabulary = held.select(F.col("word").alias("h_id")).distinct()
    for k in range(1, size + 1):
        some = short.filter(F.length("w") == k) if k < size else short.filter(F.length("w") >= k)
        found = _probed(some.select("n_id", _grams(F.col("w"), k).alias("parts")), vocabulary.select("h_id", _grams(F.col("h_id"), k).alias("parts")), "parts")
        inside = found.withColumnRenamed("h_id", "word").join(some, "n_id").filter(F.col("word").contains(F.col("w"))).select("n_id", "word")
        found = inside.join(held, "word").select("n_id", "h_id")
        pairs = found if pairs is None else pairs.unionByName(found)
    return _confirmed(pairs, n, h)


def _confirmed(pairs: DataFrame, n: DataFrame, h: DataFrame) -> DataFrame:
    """The pairs where the needle's text is a part of the other's."""
    both = pairs.distinct().join(n.select("n_id", F.col("t").alias("n_t")), "n_id").join(h.select("h_id", F.col("t").alias("h_t")), "h_id")
    return both.filter(F.col("h_t").contains(F.col("n_t"))).select("n_id", "h_id").distinct()


def covered(needles: DataFrame, hay: DataFrame) -> DataFrame:
    """(n_id, h_id) where all words of the needle but stop words are words of the other; needles without such words find nothing."""
    n = needles.select("n_id", I.tokens(F.col("text"), I.TITLE_STOP).alias("parts")).filter(F.size("parts") > 0)
    h = hay.select("h_id", I.tokens(F.col("text")).alias("parts"))
    both = _probed(n, h, "parts").join(n.withColumnRenamed("parts", "n_parts"), "n_id").join(h.withColumnRenamed("parts", "h_parts"), "h_id")
    return both.filter(F.size(F.array_except("n_parts", "h_parts")) == 0).select("n_id", "h_id").distinct()


def link_answers(petitions: DataFrame, acts: DataFrame) -> DataFrame:
    """petitions(n_id, refs, text, day), acts(h_id, number, text, day): (n_id, h_id, tier, days).

    A reference with exactly one act of that number decides (the first such one); else the only act whose title contains the petition's title; where none
    does, the only one with all its words. Title matches need dates within 45 days, and an act claimed by two petitions is given to neither.
    """
    by_number = acts.filter("number IS NOT NULL").groupBy("number").agg(F.count("*").alias("n"), F.min("h_id").alias("h_id")).filter("n = 1")
    refs = petitions.select("n_id", F.posexplode("refs").alias("place", "number"))
    exact = refs.join(by_number, "number").groupBy("n_id").agg(F.min_by("h_id", "place").alias("h_id"))
    rest = petitions.join(exact, "n_id", "left_anti")
    inside = contained(rest.select("n_id", "text"), acts.select("h_id", "text")).withColumn("tier", F.lit("title-substring"))
    others = rest.join(inside, "n_id", "left_anti")
    words = covered(others.select("n_id", "text"), acts.select("h_id", "text")).withColumn("tier", F.lit("title-tokens"))
    only = inside.unionByName(words).groupBy("n_id").agg(F.count("*").alias("n"), F.min("h_id").alias("h_id"), F.first("tier").alias("tier")).filter("n = 1").drop("n")
    dated = only.join(rest.select("n_id", F.col("day").alias("answered")), "n_id").join(acts.select("h_id", "day"), "h_id")
    dated = dated.withColumn("days", F.abs(F.datediff("answered", "day"))).filter(F.col("days") <= DAYS_APART)
    claims = dated.groupBy("h_id").agg(F.count("*").alias("n")).filter("n = 1").select("h_id")
    titled = dated.join(claims, "h_id", "left_semi").select("n_id", "h_id", "tier", "days")
    return exact.select("n_id", "h_id", F.lit("ref-exact").alias("tier"), F.lit(0).alias("days")).unionByName(titled)


def first_alias(listed: DataFrame, known: DataFrame) -> DataFrame:
    """listed(id, names, country), known(entity, name, country): (id, entity, name, place) of the first name in order that a known entity of that country bears."""
    names = listed.filter("country IS NOT NULL").select("id", "country", F.posexplode("names").alias("place", "name")).withColumn("key", I.normal_text(F.col("name"))).filter("key <> ''")
    bearer = known.withColumn("key", I.normal_text(F.col("name"))).groupBy("key", "country").agg(F.min("entity").alias("entity"))
    return names.join(bearer, ["key", "country"]).groupBy("id").agg(F.min_by(F.struct("entity", "name", "place"), "place").alias("m")).select("id", "m.entity", "m.name", "m.place")


def duplicate_decisions(entities: DataFrame) -> DataFrame:
    """entities(entity, name, country, lei, vat): (kept, dropped, decision) for equal names in a country where one has an LEI and others have none.

    Tax numbers that are '0' or shorter than three characters count as missing. Two different ones make the pair 'same_as', for review; else it is merged.
    """
    clean = F.when((F.trim("vat") != "0") & (F.length(F.trim("vat")) >= 3), F.trim("vat"))
    e = entities.select("entity", F.upper(F.trim("name")).alias("key"), "country", "lei", clean.alias("vat")).filter("key <> '' AND country IS NOT NULL")
    kept = e.filter("lei IS NOT NULL").groupBy("key", "country").agg(F.min_by(F.struct("entity", "vat"), "entity").alias("k"))
    pairs = kept.join(e.filter("lei IS NULL"), ["key", "country"])
    apart = F.coalesce(F.col("k.vat") != F.col("vat"), F.lit(False))
    return pairs.select(F.col("k.entity").alias("kept"), F.col("entity").alias("dropped"), F.when(apart, "same_as").otherwise("merge").alias("decision"))


def waterfall(sources: list[DataFrame], key: str, limit: int, *order) -> DataFrame:
    """Rows of the first source first, each key once, at most limit in all: the top-k of (source, order)."""
    rows = None
    for i, s in enumerate(sources):
        s = s.withColumn("tier", F.lit(i))
        rows = s if rows is None else rows.unionByName(s)
    first = Window.partitionBy(key).orderBy("tier", *order)
    return rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n").orderBy("tier", *order).limit(limit)


def match_counts(wanted: DataFrame, known: DataFrame, on: list[str], key: str) -> DataFrame:
    """Per wanted key: how many known entities share the columns, as matched (one), ambiguous or no_match, with the entity of a match. known has a column entity."""
    found = known.groupBy(*on).agg(F.count_distinct("entity").alias("_n"), F.min("entity").alias("_e"))
    hit = F.when(F.col("_n") == 1, "matched").when(F.col("_n") > 1, "ambiguous").otherwise("no_match")
    return wanted.join(found, on, "left").select(key, hit.alias("hint"), F.when(F.col("_n") == 1, F.col("_e")).alias("entity"))


#: Tiers of the resolver with their scores, and the least length of a name that a name tier takes.
RESOLVER_TIERS, LEAST_NAME = (("lei", 1.0), ("vat", 0.99), ("name_country", 0.95)), 6


def resolve_tiers(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted(id, lei, vat, name, country), known(entity, ...): the first tier with a candidate decides: matched where it is the only one, else ambiguous; no_match without any.
    Columns: id, hint, tier, score, entity."""
    keyed = lambda d, who: d.select(F.col(who), F.explode(F.array(
        F.struct(F.lit(0).alias("t"), F.col("lei").cast("string").alias("k")), F.struct(F.lit(1).alias("t"), F.col("vat").cast("string").alias("k")),
        F.struct(F.lit(2).alias("t"), F.when(F.length("name") >= LEAST_NAME, F.concat_ws("|", F.upper(F.trim("name")), F.col("country").cast("string"))).alias("k")))).alias("x")).select(who, "x.t", "x.k").filter("k IS NOT NULL AND k <> ''")
    found = keyed(known, "entity").groupBy("t", "k").agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("entity"))
    best = keyed(wanted, "id").join(found, ["t", "k"]).groupBy("id").agg(F.min(F.struct("t", "n", "entity")).alias("b"))
    tier, score = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, (name, points) in enumerate(RESOLVER_TIERS):
        tier, score = F.when(F.col("b.t") == i, name).otherwise(tier), F.when(F.col("b.t") == i, points).otherwise(score)
    return wanted.select("id").join(best, "id", "left").select("id", F.when(F.col("b").isNull(), "no_match").when(F.col("b.n") == 1, "matched").otherwise("ambiguous").alias("hint"),
                                                               tier.alias("tier"), score.alias("score"), F.when(F.col("b.n") == 1, F.col("b.entity")).alias("entity"))


def enrich_isins(listings: DataFrame, bulk: DataFrame) -> DataFrame:
    """listings(ticker, exchange, sector, lei, isin, place), bulk(lei, isin): equities with their own ISIN, else the smallest of the bulk map; one listing, the first by place, for a
    ticker at an exchange; without an ISIN none."""
    of_lei = bulk.groupBy("lei").agg(F.min("isin").alias("_isin"))
    rows = listings.filter("sector = 'equity'").join(of_lei, "lei", "left").withColumn("isin", F.coalesce("isin", "_isin")).filter("isin IS NOT NULL")
    return rows.groupBy("ticker", "exchange").agg(F.min_by(F.struct("lei", "isin"), "place").alias("x")).select("ticker", "exchange", "x.lei", "x.isin")


def review_list(candidates: DataFrame, decisions: DataFrame, limit: int = 50) -> DataFrame:
    """candidates(a, b, confidence) that no decision(a, b) has met yet, the surest first."""
    return candidates.join(decisions.select("a", "b"), ["a", "b"], "left_anti").orderBy(F.desc("confidence"), "a", "b").limit(limit)


def apply_decisions(candidates: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """decisions(a, b, approve): (mapping(node, canonical) of the approved pairs, candidates with their state)."""
    both = candidates.join(decisions.select("a", "b", "approve"), ["a", "b"], "left")
    state = both.withColumn("state", F.when(F.col("approve").isNull(), "pending").when(F.col("approve"), "merged").otherwise("rejected")).drop("approve")
    mapping = state.filter("state = 'merged'").groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("canonical"))
    return mapping, state


def find_tickers(known: DataFrame, text: str, limit: int = 50) -> DataFrame:
    """known(symbol, name, currency) whose symbol or name contains the text, symbols first by exactness, with the source that their filings have."""
    q = text.lower()
    hit = known.filter(F.lower("name").contains(q) | F.lower("symbol").contains(q))
    tier = F.when(F.lower("symbol") == q, 3).when(F.lower("symbol").startswith(q), 1).otherwise(0)
    return hit.withColumns({"tier": tier, "source": F.when(F.col("currency") == "USD", "edgar").otherwise("esef")}).orderBy(F.desc("tier"), "symbol", "name").limit(limit)


def lookup_keys(rows: DataFrame, known: DataFrame, key: str, found: str) -> DataFrame:
    """rows with what their key is known as (the least, if a key has several); rows without are left out. Each key is looked up once, however many rows have it."""
    return rows.join(known.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(found).alias(found)), key)


#: Exchange codes of the listings' source and the suffixes that other sources write for the same venue; fixed values.
VENUE_SUFFIXES = {
    "GY": "DE", "GF": "DE", "SM": "MC", "SQ": "MC", "IM": "MI", "NA": "AS", "FP": "PA", "LN": "L", "NO": "OL", "SS": "ST", "DC": "CO", "FH": "HE", "ID": "IR", "PW": "WA", "PL": "LS",
}


def retirements(suspects: DataFrame, canonical: DataFrame) -> DataFrame:
    """suspects(company, lei, ticker), canonical(lei, ticker, exchange, place): suspects that aren't canonical, with the canonical ticker that stands for them and by what: company, ticker, replacement, tier.

    Tiers: symbol (the suspect without its suffix is a canonical ticker), venue (its suffix is the exchange of one, as written or by VENUE_SUFFIXES), sole (there is only one); of several the first by
    place. A suspect whose LEI has no canonical listing, or none of these, is left alone: absence of evidence retires nothing.
    """
    to = F.create_map(*(F.lit(x) for kv in VENUE_SUFFIXES.items() for x in kv))
    c = canonical.select("lei", F.col("ticker").alias("_canon"), F.nullif(F.trim("exchange"), F.lit("")).alias("_raw"), "place")
    c = c.withColumns({"_alias": F.coalesce(F.try_element_at(to, F.col("_raw")), F.col("_raw"))})
    s = suspects.select("company", "lei", "ticker").distinct().join(canonical.select("lei", "ticker").distinct(), ["lei", "ticker"], "left_anti")
    dotted = F.contains("ticker", F.lit("."))
    s = s.withColumns({"_bare": F.when(dotted, F.regexp_replace("ticker", r"\.[^.]*$", "")).otherwise(F.col("ticker")), "_suffix": F.when(dotted, F.substring_index("ticker", ".", -1))})
    met = s.join(c, "lei")
    by_symbol, by_venue = F.col("_canon") == F.col("_bare"), (F.col("_suffix") != "") & ((F.col("_suffix") == F.col("_raw")) | (F.col("_suffix") == F.col("_alias")))
    best = met.groupBy("company", "lei", "ticker").agg(
        F.min_by("_canon", F.when(by_symbol, F.col("place"))).alias("symbol"), F.min_by("_canon", F.when(by_venue, F.col("place"))).alias("venue"), F.when(F.count("*") == 1, F.min("_canon")).alias("sole"))
    tier = F.when(F.col("symbol").isNotNull(), "symbol").when(F.col("venue").isNotNull(), "venue").when(F.col("sole").isNotNull(), "sole")
    return best.select("company", "ticker", F.coalesce("symbol", "venue", "sole").alias("replacement"), tier.alias("tier")).filter("replacement IS NOT NULL")
