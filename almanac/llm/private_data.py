"""Personal data: listed patterns, then terms that give a protected entity away.

The patterns find e-mail addresses, IP addresses, card and phone numbers.  Each value found is a
protected entity.  What a term t tells about an entity c is measured on the corpus:

    N        terms in all texts              n(t)    occurrences of t, both outside all entities
    n(t, c)  occurrences of t in contexts of c    n(c)    terms in contexts of c
    P(c) = n(c) / N                          P(c | t) = (n(t, c) + PRIOR * P(c)) / (n(t) + PRIOR)

P(c | t) is shrunk towards what is known without t, so every pair that occurs together is judged, a value that occurs once
included, and one occurrence tells less than many.  t tells log2(P(c | t) / P(c)) bits about c and leaves -log2 P(c | t)
open.  A term that tells a bit at least and leaves ``GENERALISE`` bits or fewer open discloses c: in texts that hold c it
is replaced by its shape; from ``REMOVE`` bits down it is removed.  A context is the text
up to ``CONTEXT`` code points before and after the entity, up to the neighbouring entity of the same kind;
words cut by its outer end are left out.  A term is a run of two or more letters, in lower case.

Only column expressions, joins and groupings are used.  Counting terms combines in
the scan; the terms counted are joined with the few that occur next to entities.

Nulls and odd rows: a null or empty text has no spans and stays as it is.  Repeated
rows count as often as they occur and get the same spans.  Any column may be null; ``doc_id`` is not
used.  An empty table gives an empty result.  Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm import spans
from almanac.llm.apart import own_columns_apart
from almanac.staging import stage

KINDS = ("email", "ip", "card", "phone", "term")
TERM = KINDS.index("term")

# The patterns, written so that a search never looks twice at a long run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

TERM_PATTERN = r"\p{L}{2,}+"

CONTEXT = 80

# Occurrences that the prior is worth, bits left open up to which a term is generalised and removed, bits it must tell.
PRIOR = 1.0
GENERALISE, REMOVE = 1.0, 0.5
TOLD = 1.0


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc + F.when(
            (n - i) % 2 == 1,
            F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(number, i, F.lit(1)).cast("int")),
        ).otherwise(F.substring(number, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def base_spans(text: Column, context: int = CONTEXT) -> Column:
    """array<struct<start, kind_no, end, value, before, after>>, kind by kind."""
    ip_ok = f"^{IP_PART}" + rf"\.{IP_PART}" * 3 + "$"

    def card_ok(m: Column) -> Column:
        number = digits(m["value"])
        return F.when(F.length(number).between(12, 19), luhn(number)).otherwise(False)

    found = (
        (EMAIL, text.contains("@"), lambda m: F.lit(True)),
        (IP, text.rlike(IP), lambda m: m["value"].rlike(ip_ok)),
        (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), card_ok),
        (PHONE, text.contains("+"), lambda m: F.length(digits(m["value"])).between(9, 15)),
    )

    def of_kind(number: int, pattern: str, guard: Column, passes: Callable[[Column], Column]) -> Column:
        def with_context(kept: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                least = F.greatest(m["start"] - context, F.when(i > 0, F.get(kept, i - 1)["end"]), F.lit(0))
                most = F.least(m["end"] + context, F.get(kept, i + 1)["start"])
                return F.struct(
                    m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"),
                    m["value"].alias("value"), F.substring(text, least + 1, m["start"] - least).alias("before"),
                    F.substring(text, m["end"] + 1, most - m["end"]).alias("after"),
                )

            return F.transform(kept, one)

        return spans.let(F.filter(spans.find(text, pattern, guard), passes), with_context)

    return F.concat(*[of_kind(number, *kind) for number, kind in enumerate(found)])


def entity(span: Column) -> Column:
    """Kind and normalised value: lower case for addresses, digits for numbers."""
    value = F.when(span["kind_no"] < 2, F.lower(span["value"])).otherwise(digits(span["value"]))
    return F.concat_ws(":", span["kind_no"].cast("string"), value)


def outside_terms(text: Column, base: Column) -> Column:
    """All terms of a text, but those in its base spans: a name inside an address is no second place where the name occurs."""
    anywhere = F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0))
    outside = F.transform(
        F.filter(
            spans.find(text, TERM_PATTERN, F.size(base) > 0),
            lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
        ),
        lambda t: t["value"],
    )
    return F.transform(F.when(F.size(base) > 0, outside).otherwise(anywhere), F.lower)


def context_terms(marked: DataFrame, context: int) -> DataFrame:
    """(__row, entity, term, start, end): the terms in the contexts of each entity, outside all base spans."""
    one = marked.where(F.size("__base") > 0).select("__row", "__base", F.explode("__base").alias("span"))
    before, after = F.col("span.before"), F.col("span.after")
    left = F.filter(
        spans.find(before, TERM_PATTERN), lambda t: (t["start"] > 0) | (F.length(before) < context)
    )
    right = F.filter(
        spans.find(after, TERM_PATTERN), lambda t: (t["end"] < F.length(after)) | (F.length(after) < context)
    )

    def placed(terms: Column, at: Column) -> Column:
        return F.transform(
            terms,
            lambda t: F.struct(F.lower(t["value"]).alias("term"), (t["start"] + at).alias("start"), (t["end"] + at).alias("end")),
        )

    all_terms = F.concat(
        placed(left, F.col("span.start") - F.length(before)), placed(right, F.col("span.end"))
    )
    return (
        one.select("__row", "__base", entity(F.col("span")).alias("entity"), F.explode(all_terms).alias("t"))
        .where(~F.exists("__base", lambda b: (b["start"] < F.col("t.end")) & (F.col("t.start") < b["end"])))
        .select("__row", "entity", "t.term", "t.start", "t.end")
    )


def disclosing(near: DataFrame, corpus: DataFrame, generalise: float, remove: float) -> DataFrame:
    """(entity, term, removed) from ``near`` (entity, term) occurrences and ``corpus`` (term, n)."""
    together = stage(near.groupBy("entity", "term").agg(F.count("*").alias("n_tc")), "co-occurrence")
    around = stage(together.groupBy("entity").agg(F.sum("n_tc").alias("n_c")), "entity-sizes")
    words = stage(corpus, "term-counts")
    total = F.lit(words.agg(F.sum("n")).first()[0] or 0)
    without = F.col("n_c") / total
    given = (F.least("n_tc", "n_t") + PRIOR * without) / (F.col("n_t") + PRIOR)
    return (
        together.join(words.withColumnRenamed("n", "n_t"), "term")
        .join(around, "entity")
        .withColumn("given", given)
        .where((F.col("given") >= 2.0**-generalise) & (F.col("given") >= 2.0**TOLD * without))
        .select("entity", "term", (F.col("given") >= 2.0**-remove).alias("removed"))
    )


def shape(value: Column) -> Column:
    """What a generalised term leaves: capitalised, upper case or neither."""
    return (
        F.when(value == F.upper(value), "<TERM>").when(F.left(value, F.lit(1)) == F.upper(F.left(value, F.lit(1))), "<Term>")
        .otherwise("<term>")
    )


def sanitised_text(text: Column, found: Column) -> Column:
    """``text`` with base spans replaced by their kind and terms generalised or removed.

    ``found`` has (start, kind_no, end, removed).  A span that starts inside earlier ones and reaches beyond
    them is replaced from their end on.  Blocks of spans are rewritten on their own part of the text first.
    """
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])

    def block(part: Column, offset: Column, of_block: Column) -> Column:
        def put(acc: Column, s: Column) -> Column:
            start, end = F.greatest(s["start"] - offset, acc["to"]), s["end"] - offset
            value = F.substring(part, start + 1, end - start)
            instead = F.when(s["kind_no"] < TERM, names[s["kind_no"]]).when(s["removed"], "").otherwise(shape(value))
            piece = F.concat(F.substring(part, acc["to"] + 1, start - acc["to"]), instead)
            return F.when(
                end > acc["to"], F.struct(end.alias("to"), F.concat(acc["pieces"], F.array(piece)).alias("pieces"))
            ).otherwise(acc)

        return F.aggregate(
            of_block,
            F.struct(F.lit(0).alias("to"), F.array().cast("array<string>").alias("pieces")),
            put,
            lambda acc: F.array_join(acc["pieces"], ""),
        )

    def rewritten(ordered: Column) -> Column:
        def reach(n: Column) -> Column:
            """End of the first ``n`` spans."""
            return F.coalesce(F.array_max(F.transform(F.slice(ordered, F.lit(1), n), lambda s: s["end"])), F.lit(0))

        def of_number(b: Column) -> Column:
            ends = F.struct(reach(b * spans.BLOCK).alias("from"), reach((b + 1) * spans.BLOCK).alias("to"))
            return spans.let(
                ends,
                lambda e: spans.let(
                    F.substring(text, e["from"] + 1, e["to"] - e["from"]),
                    lambda part: block(part, e["from"], F.slice(ordered, b * spans.BLOCK + 1, F.lit(spans.BLOCK))),
                ),
            )

        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / spans.BLOCK).cast("int")), of_number)
        return F.concat(F.array_join(blocks, ""), F.substring(text, reach(F.size(ordered)) + 1, F.length(text)))

    return F.when(F.size(found) > 0, spans.let(F.array_sort(found), rewritten)).otherwise(text)


@own_columns_apart
def sanitise(
    docs: DataFrame,
    context: int = CONTEXT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """``docs`` with spans (array of (start, kind_no, end, removed), base spans and disclosing terms) and sanitised.

    The marked documents are written once: counting, and the spans found by it, must refer to the same rows.
    """
    marked = stage(
        docs.drop("spans", "sanitised")
        .withColumn("__base", base_spans(F.col("text"), context))
        .withColumn("__row", F.monotonically_increasing_id()),
        "marked",
    )
    near = stage(context_terms(marked, context), "context-terms")
    corpus = marked.select(F.explode(outside_terms(F.col("text"), F.col("__base"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    candidates = near.select("term").distinct().withColumn("seen", F.lit(True))
    counted = corpus.join(candidates, "term", "left").select("term", "n", F.col("seen").isNotNull().alias("wanted"))
    # Terms that stand next to no entity matter for the total only.
    kept = counted.groupBy(F.when(F.col("wanted"), F.col("term")).alias("term")).agg(F.sum("n").alias("n"))
    told = stage(disclosing(near, kept, generalise, remove), "disclosing")
    terms = (
        near.join(told, ["entity", "term"])
        .groupBy("__row", "start", "end").agg(F.max("removed").alias("removed"))
        .groupBy("__row")
        .agg(F.collect_list(F.struct("start", F.lit(TERM).alias("kind_no"), "end", "removed")).alias("__terms"))
    )
    base = F.transform(
        "__base",
        lambda s: F.struct(
            s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), F.lit(False).alias("removed")
        ),
    )
    nothing = F.array().cast("array<struct<start:int,kind_no:int,end:int,removed:boolean>>")
    holders = stage(
        marked.select("__row", F.explode("__base").alias("span")).select("__row", entity(F.col("span")).alias("entity")).distinct(),
        "holders",
    )
    # All terms that an entity of a document discloses, wherever they stand in it.
    held = (
        holders.join(told, "entity")
        .groupBy("__row", "term").agg(F.max("removed").alias("removed"))
        .groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("term", "removed"))).alias("__told"))
    )

    def further(placed: Column) -> Column:
        words = F.filter(
            spans.find(F.col("text"), TERM_PATTERN, F.col("__told").isNotNull()),
            lambda t: F.map_contains_key("__told", F.lower(t["value"]))
            & ~F.exists(placed, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
        )
        return F.transform(
            words,
            lambda t: F.struct(
                t["start"].alias("start"), F.lit(TERM).alias("kind_no"), t["end"].alias("end"),
                F.element_at("__told", F.lower(t["value"])).alias("removed"),
            ),
        )

    return (
        marked.join(stage(terms, "term-spans"), "__row", "left")
        .join(stage(held, "held-terms"), "__row", "left")
        .withColumn("spans", spans.let(
            F.concat(base, F.coalesce("__terms", nothing)), lambda placed: F.array_sort(F.concat(placed, further(placed)))
        ))
        .withColumn("sanitised", sanitised_text(F.col("text"), F.col("spans")))
        .drop("__row", "__base", "__terms", "__told")
    )
