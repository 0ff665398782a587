"""Personal data by bootstrapped contextual extraction.

Four kinds have a fixed form; what fits it is a seed. Every seed, and every other word with a digit or an @, is an instance that
stands in contexts: the word before it, the two words before it, the word after it, and a name glued to it ("tel:"). A context is a
lexical pattern. The graph of patterns and instances is then scored in turns:

* a pattern trusts the kind most of its instances have: confidence = sum of their scores / (number of instances + 1.5);
* a confident pattern passes its kind on to its unknown instances: score = 1 - product of (1 - confidence) over its patterns;
* an instance with a high score counts as known in the next turn.

Instances found like this are added as spans of that kind; seeds always stay. All of it is DataFrame functions: the texts are read once,
occurrences go to a table in the shared folder, and the turns are grouped sums over distinct (pattern, instance) pairs, which combine
before the shuffle, so a frequent word is no hot task. Where an instance or pattern is frequent in a join, adaptive execution splits it.

Null text counts as empty. Repeated rows give repeated results; rows with the same id but other texts stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import let, spans, stored

#: The kinds in their order, and how they are written. Possessive forms of the plain patterns; they match the same.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
OCTETS = "^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\\.|$)){4}$"

SPACE = "\\x20\\x09-\\x0D"
#: A candidate: a phone number, a row of digit groups, or a whole word with a digit or an @.
CANDIDATE = (
    "\\+[0-9][\\x20().0-9-]+[0-9]|(?<![0-9A-Za-z])[0-9]{2,6}+(?:[\\x20-][0-9]{2,6}+){2,4}(?![0-9A-Za-z])|"
    f"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
)
GLUE = "^[^0-9A-Za-z@+]*+(?:[A-Za-z_]++[=:][\"']?+)?+"
TRAIL = ".,;:!?\"')>]}"

CONFIDENCE = 0.7
SMOOTHING = 1.5
SUPPORT = 3
TURNS = 3


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": hit.rlike(OCTETS),
        "card": F.length(digits).between(14, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(10, 15),
    }[kind]


def seeds(text: Column) -> Column:
    """array<struct<start, rank, end>> of the spans of fixed form, by start, then kind."""
    numeric = text.rlike("[0-9]")
    gates = {"email": text.contains("@"), "ip": numeric & text.contains("."), "card": numeric, "phone": text.contains("+") & numeric}
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")

    def kind(name: str) -> Column:
        good = F.filter(spans(text, PATTERNS[name]), lambda s: _valid(name, s["hit"]))
        rank = F.lit(KINDS.index(name)).cast("int")
        made = F.transform(good, lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end")))
        return F.coalesce(F.when(gates[name], made), empty)

    return F.array_sort(F.concat(*[kind(name) for name in KINDS]))


#: The first two words of a text, of any length.
TWO_WORDS = "^[ \\t-\\r]*+([^ \\t-\\r]++(?:[ \\t-\\r]++[^ \\t-\\r]++)?+)"


def _context(gap: Column, back: bool) -> Column:
    """The two words beside a candidate, lower case without outer punctuation."""
    part = F.reverse(F.regexp_extract(F.reverse(gap), TWO_WORDS, 1)) if back else F.regexp_extract(gap, TWO_WORDS, 1)
    inner = F.regexp_replace(F.lower(F.trim(F.translate(part, "\t\n\x0b\x0c\r", "     "))), "[.,;!?\"'()<>\\[\\]{}]", "")
    return F.split(inner, " +")


def occurrences(text: Column) -> Column:
    """array<struct<start, end, kind, instance, patterns>> of the candidates; kind is null unless a seed lies in it."""
    def known(hit: Column) -> Column:
        found = None
        for name in KINDS:
            part = F.regexp_extract(hit, PATTERNS[name], 0)
            good = (part != "") & _valid(name, part)
            found = F.when(good, F.lit(name)) if found is None else found.when(good, F.lit(name))
        return found

    def placed(hits: Column, gaps: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            before, after = _context(F.get(gaps, i), True), _context(F.get(gaps, i + 1), False)
            last, last2, first = F.element_at(before, -1), F.try_element_at(before, F.lit(-2)), F.element_at(after, 1)
            glue = F.regexp_extract(s["hit"], GLUE, 0)
            core = F.rtrim(F.substring(s["hit"], F.length(glue) + 1, F.length(s["hit"])), F.lit(TRAIL))
            named = F.lower(F.regexp_extract(glue, "[A-Za-z_]+[=:]", 0))
            start = s["start"] + F.length(glue)
            return F.struct(
                start.alias("start"), (start + F.length(core)).alias("end"), known(s["hit"]).alias("kind"),
                F.sha2(F.lower(core), 256).alias("instance"),
                F.array_compact(F.array(
                    F.when(last != "", F.concat(F.lit("before "), last)),
                    F.when((last != "") & (last2 != ""), F.concat(F.lit("before "), last2, F.lit(" "), last)),
                    F.when(first != "", F.concat(F.lit("after "), first)),
                    F.when(named != "", F.concat(F.lit("glued "), named)),
                )).alias("patterns"))

        return F.filter(F.transform(hits, one), lambda c: c["end"] > c["start"])

    #: the text between candidates: what stands before the first, between each two, and after the last
    gaps = F.split(F.replace(text, F.lit("\x01"), F.lit("\x02")), CANDIDATE, -1)
    found = let(spans(text, CANDIDATE), lambda hits: F.when(hits.isNotNull(), let(gaps, lambda g: placed(hits, g))))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,instance:string,patterns:array<string>>>")
    return F.coalesce(F.when(text.rlike("[0-9@]"), found), empty)


def bootstrap(edges: DataFrame, turns: int = TURNS) -> DataFrame:
    """(instance, kind, score) of the unknown instances that confident patterns point to.

    edges: distinct (pattern, instance, kind); kind is null where the instance is unknown.
    """
    spark = edges.sparkSession
    found = spark.createDataFrame([], "instance string, found_kind string, found_score double")
    for _ in range(turns):
        kinds = edges.join(found, "instance", "left").withColumn("as", F.coalesce("kind", "found_kind"))
        sums = [F.sum(F.when(F.col("as") == k, F.coalesce(F.when(F.col("kind").isNotNull(), 1.0), "found_score")).otherwise(0.0)).alias(k) for k in KINDS]
        stats = kinds.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums)
        best = F.array_max(F.array(*[F.struct(F.col(k).alias("sum"), F.lit(k).alias("kind")) for k in KINDS]))
        trusted = (
            stats.withColumn("best", best)
            .select("pattern", F.col("best.kind").alias("found_kind"), F.col("best.sum").alias("support"),
                    (F.col("best.sum") / (F.col("n") + SMOOTHING)).alias("confidence"))
            .filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))
        )
        scored = (
            edges.filter("kind is null").join(trusted, "pattern")
            .groupBy("instance", "found_kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("found_score"))
            .groupBy("instance").agg(F.max(F.struct("found_score", "found_kind")).alias("best"))
        )
        found = stored(scored.select("instance", F.col("best.found_kind").alias("found_kind"), F.col("best.found_score").alias("found_score"))
                       .filter(F.col("found_score") >= CONFIDENCE))
    return found


def extract_private(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, base, added): one row per row of docs.

    base: array<struct<start, rank, end>>, the spans of fixed form; added: the same for what the patterns discover. rank is
    the place of the kind in KINDS. Positions are code points, end exclusive.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(id).alias("id"), F.xxhash64(body).alias("text_key"), seeds(body).alias("base"), occurrences(body).alias("candidates")))
    single = rows.select("id", "text_key", F.explode("candidates").alias("c"))
    edges = stored(
        single.select(F.explode("c.patterns").alias("pattern"), F.col("c.instance").alias("instance"), F.col("c.kind").alias("kind"))
        .groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    found = bootstrap(edges)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("found_kind")).cast("int") - 1
    added = (
        single.filter("c.kind is null").select("id", "text_key", "c.start", "c.end", "c.instance").join(found, "instance")
        .groupBy("id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", rank.alias("rank"), "end"))).alias("added")))
    a, b = rows.select("id", "text_key", "base").alias("a"), added.alias("b")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.text_key") == F.col("b.text_key"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    return a.join(b, same, "left").select(
        F.col("a.id").alias(id), "a.text_key", "a.base", F.coalesce("b.added", empty).alias("added"))
