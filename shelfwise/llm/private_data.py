"""Personal data: known forms, and others that stand in the same contexts.

Forms (e-mail and IP addresses, card and telephone numbers) are found by regular
expressions. They are the seeds of a bootstrapping: the words around an
instance are its lexical patterns; a pattern is trusted as far as the instances
found with it are personal data, an unknown identifier as far as the patterns
it is found with are; after some rounds, identifiers that trusted patterns
vouch for are reported as well. All of it is DataFrame operations; the graph of
patterns and instances is an edge table, scored by grouping and joining.

Quantifiers are possessive where that changes nothing, so that no text makes an
expression slow or deep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.frames import without, written

#: The forms. What they match is checked further in `_valid`.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(FORMS)
#: Tests that a text must pass before its matches are located.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
#: Other identifiers: whole runs of identifier characters, of any length, that hold a digit or @.
CANDIDATE = r"(?<![\w.@%+-])(?=[A-Za-z._%+-]*+[0-9@])[A-Za-z0-9][A-Za-z0-9._@%+-]{3,}[A-Za-z0-9](?!\w)"

ROUNDS = 3
#: Distinct known instances that a pattern must have.
MIN_SUPPORT = 4
#: Least trust in a pattern, and in an instance, to be used further.
PATTERN_TRUST, INSTANCE_TRUST = 0.75, 0.75
#: Code points around a span that are searched for words; a word that reaches
#: further is part of no pattern.
REACH = 48

SPANS = "array<struct<kind:string,start:long,end:long>>"


def located(text: Column, pattern: str, hint: str | None = None) -> Column:
    """Leftmost matches that do not overlap, as structs of start, end (code
    points) and value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.expr("cast(array() as array<struct<start:long,end:long,value:string>>)")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
    spans = F.aggregate(pairs, begin, step, lambda state: state["spans"])
    return spans if hint is None else F.when(F.regexp_like(text, F.lit(hint)), spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def weight(digit: Column, i: Column) -> Column:
        n = digit.cast("int")
        double = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, double).otherwise(n)

    each = F.transform(F.filter(F.split(F.reverse(_digits(value)), ""), lambda d: d != ""), weight)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":  # a part is at most 255, whatever zeros it has in front
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(F.coalesce(F.nullif(p, F.lit("")).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _of_kind(text: Column, kind: str) -> Column:
    valid = F.filter(located(text, FORMS[kind], _HINTS[kind]), lambda s: _valid(kind, s["value"]))
    return F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), *[s[c].alias(c) for c in ("start", "end", "value")]))


def base_spans(text: Column) -> Column:
    """Spans of all forms, by kind and start, as structs kind, start, end, value."""
    return F.concat(*[_of_kind(text, kind) for kind in KINDS])


def only(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _patterns(text: Column, span: Column) -> Column:
    """The lexical patterns of a span: the two words before it, the words on both
    sides, and the word before alone if it is a label, as in "phone:"; digits are
    all alike. A plain word alone says too little."""

    def form(part: Column) -> Column:
        return F.regexp_replace(F.lower(part), "[0-9]", "0")

    # one more than REACH, so that a word which ends there is told from one that goes on
    begin = F.greatest(span["start"] - REACH - 1, F.lit(0))
    left = F.substring(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
    right = F.substring(text, (span["end"] + 1).cast("int"), F.lit(REACH + 1))
    left = form(F.rtrim(F.when(begin > 0, F.regexp_replace(left, r"^\S+", "")).otherwise(left)))
    right = form(F.when(F.length(right) > REACH, F.regexp_replace(right, r"\S+$", "")).otherwise(right))
    one, two = F.regexp_extract(left, r"(\S+)$", 1), F.regexp_extract(left, r"(\S+\s+\S+)$", 1)
    after = F.regexp_extract(right, r"^\s*(\S+)", 1)
    found = F.array(
        F.when(F.regexp_like(one, F.lit("[:=#]$")), F.concat(F.lit("1 "), one)),
        F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, r"\s+", " "))),
        F.when((one != "") & (after != ""), F.concat(F.lit("b "), one, F.lit(" "), after)),
    )
    return F.array_compact(found)


def _instance(value: Column) -> Column:
    """What tells identifiers apart: their letters in lower case, long ones by a hash."""
    low = F.lower(value)
    return F.when(F.length(low) > 64, F.md5(low)).otherwise(low)


def _instances(texts: DataFrame) -> DataFrame:
    """key, base (spans), seen (spans of base and candidates with patterns), for
    each distinct text that has any."""
    base = texts.withColumn("base", base_spans(F.col("text")))
    free = F.filter(
        located(F.col("text"), CANDIDATE, "[0-9@]"),
        lambda c: ~F.exists(F.col("base"), lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])),
    )
    unknown = F.transform(
        free, lambda c: F.struct(F.lit(None).cast("string").alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"))
    )
    every = base.withColumn("every", F.concat("base", unknown)).where(F.size("every") > 0)

    def seen(s: Column) -> Column:
        return F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            _instance(s["value"]).alias("instance"), _patterns(F.col("text"), s).alias("patterns"),
        )

    spans = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = every.select("key", spans.alias("base"), F.transform("every", seen).alias("seen"))
    return rows.groupBy("key").agg(F.any_value("base").alias("base"), F.any_value("seen").alias("seen"))


def _trusted(edges: DataFrame) -> DataFrame:
    """pattern, kind, instance for unknown instances that patterns vouch for.

    `edges` has one row for each pattern, instance and kind (null: unknown).
    Patterns with fewer than MIN_SUPPORT known instances can never be trusted in
    the first round and gain only by instances found in it; each round groups
    edges by pattern, then by instance, and joins the two.
    """
    trust = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("trust")).distinct()
    unknown = edges.where("kind is null").select("pattern", "instance")
    size = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("n"))
    links = edges.select("pattern", "instance").distinct()
    vouched = None
    for i in range(ROUNDS):
        if i == 0:  # the kind of a known instance stands in the edge itself
            mass = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("known"), F.sum(F.lit(1.0)).alias("mass"))
        else:
            mass = links.join(trust, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("known"), F.sum("trust").alias("mass"))
        patterns = (
            mass.where(F.col("known") >= MIN_SUPPORT)
            .join(size, "pattern")
            .select("pattern", "kind", (F.col("mass") / (F.col("n") + 1)).alias("trust"))
            .where(F.col("trust") >= PATTERN_TRUST)
        )
        vouched = written(unknown.join(patterns, "pattern"), f"vouched-{i}")
        found = vouched.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("trust"))
        found = found.where(F.col("trust") >= INSTANCE_TRUST)
        if i < ROUNDS - 1:
            seeds = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("trust")).distinct()
            trust = written(seeds.unionByName(found.join(seeds.select("instance"), "instance", "left_anti")), f"trust-{i}")
    return vouched.join(found.select("instance", "kind"), ["instance", "kind"]).select("pattern", "kind", "instance")


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with `base` and `spans`, arrays of structs kind, start, end
    (code points, end exclusive) by kind as in KINDS, then start. `spans` has the
    base spans and those the bootstrapping adds. These replace columns of the
    same names.

    Null texts are empty. Repeated texts get equal spans and count once as
    evidence. Identifiers that overlap a base span are never added. An empty
    table gives an empty result.
    """
    keyed = without(docs, ["base", "spans"]).withColumn("__key", F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).where(F.regexp_like("text", F.lit("[0-9@]")))
    known = written(_instances(texts.withColumn("key", F.md5("text"))), "instances")

    seen = known.select("key", F.explode("seen").alias("s")).select("key", "s.*")
    each = seen.select("key", "kind", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    edges = written(each.select("pattern", "instance", "kind").distinct(), "edges")
    trusted = _trusted(edges)
    added = (
        each.where("kind is null").drop("kind").join(trusted, ["pattern", "instance"])
        .groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.expr(f"cast(array() as {SPANS})")
    found = known.select("key", "base").join(added, "key", "left").withColumn("added", F.coalesce("added", none))
    order = [F.array_sort(only(F.concat("base", "added"), kind)) for kind in KINDS]
    spans = found.select(F.col("key").alias("__key"), "base", F.concat(*order).alias("spans"))
    joined = keyed.join(spans, "__key", "left").drop("__key")
    return joined.withColumns({c: F.coalesce(c, none) for c in ("base", "spans")})


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that
    overlap an earlier one are cut to what is left of them."""

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, begin, step, rest)).otherwise(text)


def digest_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counts(spans: Column) -> dict[str, Column]:
    return {f"n_{kind}": F.size(only(spans, kind)).cast("long") for kind in KINDS}
