r"""Information-theoretic sanitisation of personal data.

Personal data of fixed form (e-mail, IP, card and phone numbers) are found by
patterns. The values found are the entities to protect. A name that keeps company
with an entity can give it away although the entity itself is masked, also in a
document that never mentions the entity. The corpus is asked how strongly. A term
stands beside an entity where it is on the entity's line, the line before or the
line after (a signature block). Over documents, with ``n(e)`` that hold the entity,
``n(t)`` that hold the term anywhere and ``n(e, t)`` where it stands beside it,

    p(e | t)         = (n(e, t) + PRIOR * p(e)) / (n(t) + PRIOR)
    disclosure(e, t) = log(p(e | t) / p(e)) / log(1 / p(e)),

the pointwise mutual information over the information content of the entity. The
prior shrinks what is known from few documents towards independence. A term gives
the entity away when its disclosure reaches ``DISCLOSURE`` and ``p(e | t)`` reaches
``CERTAINTY``: a word that is used elsewhere fails. So does a term that is explained
by the template that entities of a kind share ("Mail:", "Tel."): of the documents where
it stands beside any entity of the kind, less than ``SHARED`` have it beside this one.
Candidates are names and codes: terms that start with a capital or a letter of a
script without case, or hold a digit. Words that are written small are never hidden.

A term that gives any entity away is sanitised in every document of the corpus: a
term with a digit is removed, any other generalised to ``[TERM]``.

Plan: patterns run once per text, and once more on the lines of texts with an
entity. Only these texts give pairs. The corpus is cut into terms twice, each time
against a small table in the same stage (candidates, to count ``n(t)`` with a partial
aggregation; then the terms that give something away, to find who holds them); the
tables' rows are counted, up to ``BROADCAST_ROWS`` they are broadcast and beyond that
joined by shuffling. Neither is run where no text has an entity. Places of terms are
found by cutting the few texts that hold one, not by patterns made of terms.

Defined cases: a null or empty text has no spans; matches that fail their check
are dropped without a retry; a term that overlaps a pattern's span adds no span of
its own; repeated rows count each and agree; an empty table gives an empty result.
Input columns named as result columns are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import identity, let, staged, without

DISCLOSURE, CERTAINTY, SHARED, PRIOR = 0.5, 0.4, 0.9, 0.5
#: Terms that may be broadcast: some 32 bytes each, 32 MB.
BROADCAST_ROWS = 1_000_000
KINDS = ("email", "ip", "card", "phone", "term")
#: Each pattern finds what its plain form finds; the look-behind (or the end of
#: the match before) and the possessive loops only keep long runs linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a pattern cannot match, where there is one.
NEEDS = {"email": "@", "phone": "+"}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
_TERM = r"[\p{L}\p{N}]+"
_TERM_GAP = r"[^\p{L}\p{N}]+"
#: Two characters at least, and a name or a code by its looks.
_NAME = r"^(?=..)(?:[\p{Lu}\p{Lt}\p{Lo}]|.*\p{N})"
_STEP = 256
RESULT = ("base_spans", "all_spans", "n_email", "n_ip", "n_card", "n_phone", "sanitised")


# ----------------------------------------------------------------- patterns
def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    value = lambda k: F.substring(digits, n - k, F.lit(1)).cast("int")
    weigh = lambda k: F.when(k % 2 == 0, value(k)).otherwise(F.floor(value(k) * 2 / 10).cast("int") + value(k) * 2 % 10)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, k: a + weigh(k)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(_OCTETS)
    low, high = (12, 19) if kind == "card" else (9, 15)
    right = F.length(_digits(match)).between(low, high)
    return right & _luhn(_digits(match)) if kind == "card" else right


def _found(kind: str, text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))


def _possible(kind: str, text: Column) -> Column:
    pattern = text.rlike(PATTERNS[kind])
    return F.contains(text, F.lit(NEEDS[kind])) & pattern if kind in NEEDS else pattern


def _running(lengths: Column, begin: Column) -> Column:
    """The sums of what comes before each length, from ``begin``."""
    step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(lengths, F.struct(begin.cast("int").alias("at"), F.array().cast("array<int>").alias("out")), step, lambda a: a["out"])


def _starts(lengths: Column) -> Column:
    """Sums of what comes before each length, in steps: an array grows within a step only."""
    steps = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.lit(_STEP)).cast("int"))
    part = lambda c: F.slice(lengths, c * _STEP + 1, _STEP)
    sums = F.transform(steps, lambda c: F.aggregate(part(c), F.lit(0), lambda a, x: a + x))
    return let(_running(sums, F.lit(0)), lambda begins: F.flatten(F.transform(steps, lambda c: _running(part(c), F.get(begins, c)))))


def _placed(text: Column, pattern: Column, matches: Column) -> Column:
    """(start, end, value) of matches, from the lengths of what lies between them."""

    def cut(gaps: Column, got: Column) -> Column:
        # A match and the gap before it are one step; a match starts behind its gap.
        lengths = F.transform(got, lambda x, k: F.length(F.get(gaps, k)) + F.length(x))
        begins = let(lengths, _starts)
        start = lambda s, k: s + F.length(F.get(gaps, k))
        return F.transform(begins, lambda s, k: F.struct(start(s, k).alias("start"), (start(s, k) + F.length(F.get(got, k))).alias("end"), F.get(got, k).alias("value")))

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), matches.alias("got")), lambda x: cut(x["gaps"], x["got"]))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")


def _spans_of(kind: str, text: Column) -> Column:
    placed = _placed(text, F.lit(PATTERNS[kind]), _found(kind, text))
    kept = F.filter(placed, lambda s: _valid(kind, s["value"]))
    shaped = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.when(_possible(kind, text), shaped).otherwise(_no_spans())


def base_spans(text: Column) -> Column:
    """Pattern spans by start, then kind: structs (start, kind, end, value) in code points, end exclusive."""
    return F.sort_array(F.concat(*[_spans_of(k, text) for k in PATTERNS]))


def _entity(span: Column) -> Column:
    """What two spellings of one value share."""
    name = F.element_at(F.array(*map(F.lit, KINDS)), span["kind"] + 1)
    return F.concat(name, F.lit(":"), F.when(span["kind"] == 0, F.lower(span["value"])).otherwise(_digits(span["value"])))


def described(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


# ------------------------------------------------------------ co-occurrence
def _terms(line: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(line), _TERM_GAP), ""))


def _without_matches(line: Column) -> Column:
    for pattern in PATTERNS.values():
        line = F.regexp_replace(line, pattern, " ")
    return line


def _beside(holders: DataFrame) -> DataFrame:
    """(id, times, entities, near) of each line with an entity: its entities and the names near it."""
    lines = F.split("text", "\n")
    at = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.array_contains(F.array(*[_possible(k, F.get("lines", i)) for k in PATTERNS]), True))
    around = F.transform(at, lambda i: F.struct(F.get("lines", i).alias("line"), F.concat_ws("\n", F.slice("lines", F.greatest(i, F.lit(1)), F.when(i == 0, 2).otherwise(3))).alias("window")))
    rows = holders.select("id", "times", lines.alias("lines")).select("id", "times", F.explode(around).alias("x")).select("id", "times", "x.line", "x.window")
    found = rows.select("id", "times", "window", F.array_distinct(F.transform(base_spans(F.col("line")), _entity)).alias("entities")).where(F.size("entities") > 0)
    names = F.filter(F.split(_without_matches(F.col("window")), _TERM_GAP), lambda x: x.rlike(_NAME))
    return found.select("id", "times", "entities", F.array_distinct(F.transform(names, lambda x: F.lower(x))).alias("near"))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def revealing_terms(texts: DataFrame, holders: DataFrame, disclosure: float = DISCLOSURE, certainty: float = CERTAINTY, shared: float = SHARED, prior: float = PRIOR) -> DataFrame:
    """(term, disclosure) of every term that gives an entity away, with the highest value it has for one.

    ``texts`` has every row of the corpus (text), ``holders`` the different texts
    with an entity (id, text, times: rows that have it).
    """
    beside = staged(_beside(holders))
    by_entity = beside.select("id", "times", F.explode("entities").alias("entity"), "near")
    c_e = by_entity.select("id", "times", "entity").distinct().groupBy("entity").agg(F.sum("times").alias("c_e"))
    near = by_entity.select("id", "times", "entity", F.substring_index("entity", ":", 1).alias("kind"), F.explode("near").alias("term"))
    met = staged(near.distinct().groupBy("entity", "kind", "term").agg(F.sum("times").alias("c_et")))
    company = near.drop("entity").distinct().groupBy("kind", "term").agg(F.sum("times").alias("c_kt"))
    candidates = staged(met.select("term").distinct())
    held = texts.where("text is not null").select(F.explode(_terms(F.col("text"))).alias("term"))
    c_t = held.join(_small(candidates), "term").groupBy("term").agg(F.count("*").alias("c_t"))
    n = F.lit(float(max(1, texts.where("text is not null").count())))

    known = met.join(c_t, "term").join(c_e, "entity").join(company, ["term", "kind"])
    p_e = F.col("c_e") / n
    p = (F.col("c_et") + F.lit(prior) * p_e) / (F.col("c_t") + F.lit(prior))
    own = F.col("c_et") >= F.lit(shared) * F.col("c_kt")
    scored = known.where((p_e < 1) & own).select("term", p.alias("p"), (F.log(p / p_e) / F.log(F.lit(1.0) / p_e)).alias("disclosure"))
    return scored.where((F.col("p") >= certainty) & (F.col("disclosure") >= disclosure)).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Spans of the listed terms outside the pattern spans."""
    placed = _placed(text, F.lit(_TERM), F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)))
    mine = F.filter(placed, lambda s: F.array_contains(terms, F.lower(s["value"])))
    free = F.filter(mine, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    shaped = F.transform(free, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index("term")).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.when(terms.isNotNull(), shaped).otherwise(_no_spans())


def _masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced; of spans that overlap the first one counts."""
    name = lambda s: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), s["kind"] + 1)
    mask = lambda s: F.when((s["kind"] == KINDS.index("term")) & s["value"].rlike("[0-9]"), F.lit("")).otherwise(name(s))
    piece = lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), mask(s)).alias("out"))
    step = lambda a, s: F.when(s["start"] >= a["at"], piece(a, s)).otherwise(F.struct(a["at"].alias("at"), a["out"].alias("out")))
    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with base_spans, all_spans (structs), counts per kind and the sanitised text."""
    texts = docs.select("text").where("text is not null")
    found = texts.select("text", base_spans(F.col("text")).alias("base")).where(F.size("base") > 0)
    found = staged(found.groupBy(identity("text").alias("id")).agg(F.count("*").alias("times"), F.first("text").alias("text"), F.first("base").alias("base")))
    marks = found.select("id", "base", F.lit(None).cast("array<string>").alias("terms"))
    if not found.isEmpty():
        terms = staged(revealing_terms(texts, found.select("id", "text", "times"), **options).select("term"))
        hold = texts.select(identity("text").alias("id"), F.explode(_terms(F.col("text"))).alias("term")).join(_small(terms), "term")
        own = hold.distinct().groupBy("id").agg(F.collect_list("term").alias("terms"))
        both = marks.unionByName(own.select("id", F.lit(None).cast(marks.schema["base"].dataType).alias("base"), "terms"))
        marks = both.groupBy("id").agg(F.first("base", ignorenulls=True).alias("base"), F.first("terms", ignorenulls=True).alias("terms"))
    # Written and merged, not broadcast: they grow with the texts, and the copies of one text can be split.
    marks = staged(marks)

    kept = without(docs, *RESULT, "__id", "base", "terms", "added")
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT])
    names = {c: f"__own_{n}" for n, c in enumerate(plain.columns) if c not in kept.columns}
    keyed = plain.withColumnsRenamed(names).withColumn("__id", F.when(F.col("text").isNotNull(), identity("text")))
    joined = keyed.join(marks.withColumnRenamed("id", "__id").hint("merge"), "__id", "left").withColumn("base", F.coalesce("base", _no_spans()))
    joined = joined.withColumn("added", _term_spans(F.col("text"), F.col("terms"), F.col("base")))
    of_kind = lambda n: F.filter("base", lambda s: s["kind"] == n)
    counts = [F.size(of_kind(KINDS.index(k))).cast("long").alias(f"n_{k}") for k in PATTERNS]
    everything = F.sort_array(F.concat("base", "added"))
    own = [F.col(f"`{names.get(c, c)}`").alias(c) for c in plain.columns]
    return joined.select(*own, F.col("base").alias("base_spans"), everything.alias("all_spans"), *counts, F.when(F.col("text").isNotNull(), _masked(F.col("text"), everything)).alias("sanitised"))
