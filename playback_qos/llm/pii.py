"""Personal data by patterns, and terms that disclose it by their corpus co-occurrence. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import written

KINDS = ("email", "ip", "card", "phone")

# The kinds' patterns, with possessive repeats where giving back characters could never
# help, so that no match recurses, and with starts inside a run left out where the run's
# own start has failed already (\G: right after the match before).
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: Stands for each code point of a base span where terms are looked for.
_MASK = "\uffff"
#: A term: a whole run of three letters or more, or of one or two that starts with a capital
#: or is of a script without case. None that touches a base span.
TERM = rf"(?<![\p{{L}}{_MASK}])(?:\p{{L}}{{3,}}+|[\p{{Lu}}\p{{Lt}}\p{{Lo}}]\p{{L}}?+(?!\p{{L}}))(?!{_MASK})"
#: Documents in which a term and an entity must meet to be judged.
MIN_SUPPORT = 3
#: Share of an entity's information that a term may disclose before it is generalised, and removed.
GENERALISE = 0.75
REMOVE = 0.9


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it (inside other lambdas too)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(steps: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each entry of an array, ``add`` over it and all before it, from ``zero``.

    In blocks of the square root of the array's length, so 20,000 entries take
    some three million steps; ``add`` is associative and ``zero`` its neutral.
    """
    all_of = lambda x: F.aggregate(x, zero, add)

    def over(s: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(s))).cast("int"))
        starts = F.filter(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int")), lambda _: F.size(s) > 0)
        return _let(F.transform(starts, lambda b: F.slice(s, b * width + 1, width)), blocks)

    def blocks(parts: Column) -> Column:
        return _let(F.transform(parts, all_of), lambda sums: F.flatten(F.transform(parts, lambda part, j: block(part, F.slice(sums, F.lit(1), j)))))

    def block(part: Column, before: Column) -> Column:
        return _let(all_of(before), lambda o: F.transform(part, lambda _, i: add(o, all_of(F.slice(part, F.lit(1), i + 1)))))

    return _let(steps, over)


def _sums(steps: Column) -> Column:
    return _running(steps.cast("array<bigint>"), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _located(text: Column, pattern: str) -> Column:
    """array<struct<value, end>> of the leftmost, non-overlapping matches, in code points; each pattern runs twice a text."""

    def ends(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(between, found, lambda a, b: (F.length(a) + F.length(b)).cast("long"))
        return F.zip_with(found, _sums(steps), lambda v, end: F.struct(v.alias("value"), end.alias("end")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), ends)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, less 9 where above; the sum is a multiple of 10."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + F.coalesce(b, F.lit(0)),
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind, then start; end exclusive."""
    digit = text.rlike("[0-9]")
    likely = {
        "email": F.contains(text, F.lit("@")),
        "ip": digit & text.rlike(r"[0-9]\.[0-9]"),
        "card": digit & text.rlike("[0-9](?:[ -]?[0-9]){12}"),
        "phone": F.contains(text, F.lit("+")) & digit,
    }
    kind_of = "array<struct<kind: string, start: long, end: long, value: string>>"

    def spans(kind: str) -> Column:
        valid = F.filter(_located(text, PATTERNS[kind]), lambda x: _valid(kind, x["value"]))
        return F.transform(
            valid,
            lambda x: F.struct(
                F.lit(kind).alias("kind"),
                (x["end"] - F.length(x["value"])).cast("long").alias("start"),
                x["end"].cast("long").alias("end"),
                x["value"].alias("value"),
            ),
        ).cast(kind_of)

    return F.concat(*[F.when(likely[k], spans(k)).otherwise(F.array().cast(kind_of)) for k in KINDS])


def _entity(s: Column) -> Column:
    return F.concat_ws(":", s["kind"], F.when(s["kind"] == "email", F.lower(s["value"])).otherwise(_digits(s["value"])))


def _masked(text: Column, spans: Column) -> Column:
    """The text, of the same length, with _MASK all over its base spans.

    Pieces between the spans' ends (each span's own and the greatest before it)
    are joined. Characters are taken from an array, so a piece costs what it holds.
    """
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def pieces(s: Column, reach: Column, letters: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            at = F.when(i > 0, F.element_at(reach, F.greatest(i, F.lit(1)))).otherwise(F.lit(0).cast("long"))
            gap = F.slice(letters, (at + 1).cast("int"), F.greatest(x["start"] - at, F.lit(0).cast("long")).cast("int"))
            fill = F.repeat(F.lit(_MASK), F.greatest(x["end"] - F.greatest(x["start"], at), F.lit(0).cast("long")).cast("int"))
            return F.concat(F.array_join(gap, ""), fill)

        last = F.element_at(reach, -1)
        rest = F.array_join(F.slice(letters, (last + 1).cast("int"), F.size(letters)), "")
        return F.concat(F.array_join(F.transform(s, piece), ""), rest)

    ends = lambda s: _running(F.transform(s, lambda x: x["end"]), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))
    letters = F.split(text, "")
    masked = _let(order, lambda s: _let(ends(s), lambda reach: _let(letters, lambda x: pieces(s, reach, x))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def _terms(body: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)), F.lower))


def _term_hashes(body: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(F.lower(w))))


def _places(body: Column, removed: Column, generalised: Column) -> Column:
    """array<struct<start, end, action>> of all terms whose hashes are listed."""

    def listed(words: Column) -> Column:
        between = F.slice(F.split(body, TERM, -1), F.lit(1), F.size(words))
        steps = F.zip_with(between, words, lambda a, w: (F.length(a) + F.length(w)).cast("long"))

        def place(w: Column, end: Column) -> Column:
            h = F.xxhash64(F.lower(w))
            action = F.when(F.array_contains(removed, h), "remove").when(F.array_contains(generalised, h), "generalise")
            return F.struct((end - F.length(w)).alias("start"), end.alias("end"), action.alias("action"))

        return F.filter(F.zip_with(words, _sums(steps), place), lambda x: x["action"].isNotNull())

    return _let(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)), listed)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, spans, entities, body) of every row: its base spans, their distinct entities, and the text
    with the spans masked. Texts and spans are written once."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    spans = written(rows.withColumn("spans", base_spans(F.col("text"))))
    return spans.select(
        "row",
        "key",
        "spans",
        F.array_distinct(F.transform("spans", _entity)).alias("entities"),
        _masked(F.col("text"), F.col("spans")).alias("body"),
    )


def disclosing_terms(
    found: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, min_support: int = MIN_SUPPORT
) -> DataFrame:
    """(term, entity, disclosure, action) of the terms that reveal too much of an entity.

    With N documents, n(t) that hold the term, n(e) the entity, and n(t, e)
    both, anywhere in the text, the term's pointwise mutual information
    log2(N n(t, e) / (n(t) n(e))) is set against the entity's own information
    log2(N / n(e)): 1 if the term only ever shares a document with the entity.
    From ``generalise`` on the term is generalised, from ``remove`` on removed.
    All counts are of documents and over all rows; each row counts a term,
    entity or pair once before anything moves. A pair is made only if it can
    reach the threshold: term and entity in ``min_support`` documents or more,
    and n(t) at most N**(1 - generalise) * n(e)**generalise, since n(t, e) is at
    most n(e). That leaves out the common words of a long page, and loses none
    that discloses. A pair met in fewer documents is not judged: every rare word
    of a single page, or of its copy, would disclose all that the page holds.
    """
    n_docs = found.count()
    some = found.filter(F.size("entities") > 0)
    entities = written(
        some.select(F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n_entity"))
        .filter(F.col("n_entity") >= min_support)
    )
    judged_rows = written(some.select("row", F.explode("entities").alias("entity")).join(entities, "entity"))
    most = entities.agg(F.max("n_entity")).first()[0] or 0

    def limit(n_entity):
        """n(t) of a term that meets the entity in all of its documents and just reaches the threshold."""
        return F.lit(1 + 1e-9) * F.pow(F.lit(float(n_docs)), 1 - generalise) * F.pow(n_entity, generalise)

    words = written(
        found.select(F.explode(_term_hashes(F.col("body"))).alias("term_hash"))
        .groupBy("term_hash")
        .agg(F.count("*").alias("n_term"))
        .filter((F.col("n_term") >= min_support) & (F.col("n_term") <= limit(F.lit(float(most)))))
    )
    terms = (
        some.join(judged_rows.select(F.col("row").alias("_row")), F.col("row") == F.col("_row"), "left_semi")
        .select("row", F.explode(_terms(F.col("body"))).alias("term"))
        .withColumn("term_hash", F.xxhash64("term"))
        .join(words, "term_hash")
    )
    judged = (
        terms.join(judged_rows, "row")
        .filter(F.col("n_term") <= limit(F.col("n_entity")))
        .groupBy("term", "entity")
        .agg(F.count("*").alias("n_pair"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
        .filter(F.col("n_pair") >= min_support)
    )
    information = F.log2(F.lit(float(n_docs)) / F.col("n_entity"))
    mutual = F.log2(F.lit(float(n_docs)) * F.col("n_pair") / (F.col("n_term") * F.col("n_entity")))
    return (
        judged.withColumn("disclosure", F.when(information > 0, mutual / information).otherwise(0.0))
        .filter(F.col("disclosure") >= generalise)
        .select(
            "term",
            "entity",
            "disclosure",
            F.when(F.col("disclosure") >= remove, F.lit("remove")).otherwise(F.lit("generalise")).alias("action"),
        )
    )


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """(key, spans) of every row, spans being array<struct<kind, start, end, action>>.

    Base spans come first, by kind as listed and start, with action 'replace';
    then disclosing terms by start (kind 'term', action 'generalise' or
    'remove', the stronger if it discloses several entities), wherever they
    stand in any text, also in one without the entity, leaving out terms that
    touch a base span. A null or empty text has none. Repeated rows are
    documents each, a null key is kept, extra columns are not read. Texts are
    shuffled once, to the list of rows with a disclosing term. An entity or term in very many documents is counted
    from partial sums, and its rows are split by the adaptive join.
    """
    found = find(docs, key, text)
    actions = written(
        disclosing_terms(found, **thresholds)
        .groupBy(F.xxhash64("term").alias("term_hash"))
        .agg(F.max("action").alias("action"))  # 'remove' outdoes 'generalise'
    )
    hits = written(
        found.select("row", F.explode(_term_hashes(F.col("body"))).alias("term_hash"))
        .join(actions, "term_hash")
        .groupBy("row")
        .agg(
            F.collect_list(F.when(F.col("action") == "remove", F.col("term_hash"))).alias("removed"),
            F.collect_list(F.when(F.col("action") != "remove", F.col("term_hash"))).alias("generalised"),
        )
    )
    extra = F.when(F.col("removed").isNotNull(), _places(F.col("body"), F.col("removed"), F.col("generalised")))
    kind_of = "array<struct<kind: string, start: long, end: long, action: string>>"
    base = F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"], F.lit("replace").alias("action")))
    more = F.transform("extra", lambda s: F.struct(F.lit("term").alias("kind"), s["start"], s["end"], s["action"]))
    return (
        found.join(hits.hint("merge"), "row", "left")  # one plan at every size: texts move once
        .withColumn("extra", extra)
        .select(
            F.col("key").alias(key),
            F.concat(base.cast(kind_of), F.coalesce(more.cast(kind_of), F.array().cast(kind_of))).alias("spans"),
        )
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with base spans as <KIND>, generalised terms as <TERM> and removed terms left out.

    Of spans that overlap, the one that starts first is taken, then the longer.
    """
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("e"), s["kind"], s["action"])))

    def put(a: Column, s: Column) -> Column:
        mark = F.when(s["action"] == "remove", "").otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        gap = F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(s["start"] < a["at"], a).otherwise(
            F.struct(F.concat(a["out"], gap, mark).alias("out"), (-s["e"]).cast("long").alias("at"))
        )

    return F.aggregate(order, zero, put, lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"))))
