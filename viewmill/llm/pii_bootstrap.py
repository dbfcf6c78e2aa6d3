"""Personal data: base patterns, and identifiers that occur in the contexts of known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import join_documents, let, match_spans, running, staged, with_key

# The kinds of base spans in their order. The look-behinds and possessive quantifiers change no match;
# they spare the attempts that cannot succeed, so that a long run of letters or digits takes linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have, to be worth splitting.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
KINDS = tuple(PATTERNS)
#: Identifier-like tokens: runs without blanks that have a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Signs around a token that are not part of an identifier.
OPENING, CLOSING = "([\"'<", ")]\"'>.,;:!?"
#: A pattern needs so many different known instances, and this mean score of all its instances, to be trusted.
MIN_KNOWN, MIN_SCORE = 5, 0.8
_SPANS = "array<struct<start: bigint, end: bigint, match: string, before: string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right is doubled, less 9 above 9."""

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.transform(F.sequence(F.lit(1), F.length(digits)), value)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    n = F.length(_digits(match))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _part_before(pieces: Column, matches: Column, i: Column) -> Column:
    """What lies between a match and the blank, or the match, before it; empty for a match that begins its word."""
    piece = pieces[i]
    return F.when(F.substring(piece, -1, 1).rlike(r"\S"), F.regexp_extract(piece, r"(?<!\S)\S++$", 0)).otherwise("")


def _words_before(pieces: Column, matches: Column, i: Column) -> Column:
    """Text that ends with the last two words before a match, which is a whole word as all matches are."""
    tail = F.substring(pieces[i], -80, 80)
    more = F.concat_ws("", F.get(matches, i - 2), F.get(pieces, i - 1), F.get(matches, i - 1), pieces[i])
    return F.when(tail.rlike(r"\s\S++\s++\S++\s*+$"), tail).otherwise(more)


def base_spans(text: Column, kind: str) -> Column:
    """Matches of one kind that pass its test."""
    found = F.when(text.rlike(NEEDS[kind]), match_spans(text, PATTERNS[kind], _part_before))
    return F.filter(F.coalesce(found, F.array().cast(_SPANS)), lambda s: _valid(kind, s["match"]))


def _patterns(before: Column) -> Column:
    """Lexical patterns in the text before a span: its last word, and its last two; digits count as one, A-Z in lower case."""
    plain = F.regexp_replace(F.lower(before), "[0-9]+", "0")
    one = F.regexp_extract(plain, r"(?<!\S)(\S++)\s*+$", 1)
    two = F.regexp_extract(plain, r"(?<!\S)(\S++\s++\S++)\s*+$", 1)
    return F.filter(F.array(one, two), lambda p: p != "")


def _event(at: Column, kind: int, i: Column, value: Column) -> Column:
    """A place in a text, to be sorted."""
    return F.struct(
        at.cast("long").alias("at"), F.lit(kind).alias("kind"), i.cast("int").alias("i"), value.cast("long").alias("value")
    )


def _greatest_before(events: Column, kind: int) -> Column:
    """For each event of a kind, in its own order: the greatest value of the events before it, or 0."""

    def walk(ordered: Column) -> Column:
        greatest = running(F.transform(ordered, lambda e: e["value"]), lambda a, b: F.greatest(a, b))
        paired = F.zip_with(ordered, greatest, lambda e, g: F.struct(e["kind"].alias("kind"), e["i"].alias("i"), g.alias("g")))
        mine = F.transform(F.filter(paired, lambda p: p["kind"] == kind), lambda p: F.struct(p["i"], p["g"]))
        return F.transform(F.sort_array(mine), lambda p: p["g"])

    return let(F.sort_array(events), walk)


def _mentions(text: Column, base: list[Column]) -> Column:
    """Base spans, and tokens that touch none: ``start``, ``end``, ``instance``, ``seed`` and ``patterns``.

    Seeds and tokens are merged in the order of their places, so work grows with their number and not with its square.
    """
    found = F.when(text.rlike("[0-9@]"), match_spans(text, TOKEN, _words_before))

    def mention(start: Column, end: Column, instance: Column, seed: bool, patterns: Column) -> Column:
        return F.struct(
            start.cast("long").alias("start"),
            end.cast("long").alias("end"),
            F.lower(instance).alias("instance"),
            F.lit(seed).alias("seed"),
            patterns.alias("patterns"),
        )

    def candidate(t: Column) -> Column:
        opened = F.ltrim(t["match"], F.lit(OPENING))
        start = t["start"] + F.length(t["match"]) - F.length(opened)
        return let(
            F.rtrim(opened, F.lit(CLOSING)),
            lambda inner: mention(start, start + F.length(inner), inner, False, _patterns(t["before"])),
        )

    def seeds(known: Column, tokens: Column) -> Column:
        """A base span has a digit or an at sign in its first word, so that word is a token: the last to begin before it."""
        starts = F.transform(known, lambda s, i: _event(s["start"], 1, i, F.lit(0)))
        words = F.transform(tokens, lambda t, i: _event(t["start"], 0, i, i))
        return F.zip_with(
            known,
            _greatest_before(F.concat(starts, words), 1),
            lambda s, at: mention(
                s["start"],
                s["end"],
                s["match"],
                True,
                F.when(s["before"] != "", _patterns(s["before"])).otherwise(_patterns(F.get(tokens, at.cast("int"))["before"])),
            ),
        )

    def untouched(known: Column, tokens: Column) -> Column:
        """A token touches a base span if one that begins before its end ends after its start."""
        starts = F.transform(known, lambda s, i: _event(s["start"], 1, i, s["end"]))
        ends = F.transform(tokens, lambda t, i: _event(t["end"], 0, i, F.lit(0)))
        free = F.zip_with(
            tokens, _greatest_before(F.concat(starts, ends), 0), lambda t, reach: F.when(reach <= t["start"], t)
        )
        return F.filter(free, lambda t: t.isNotNull())

    def both(known: Column, tokens: Column) -> Column:
        none = F.size(known) == 0
        others = F.transform(F.when(none, tokens).otherwise(untouched(known, tokens)), candidate)
        others = F.filter(others, lambda m: F.length(m["instance"]) >= 4)
        return F.when(none, others).otherwise(F.concat(seeds(known, tokens), others))

    return let(
        F.concat(*base), lambda known: let(F.coalesce(found, F.array().cast(_SPANS)), lambda tokens: both(known, tokens))
    )


def _trusted(mentions: DataFrame, min_known: int, min_score: float) -> DataFrame:
    """Patterns with their scores, from the graph of patterns and instances.

    An instance that is a seed scores 1, any other 1 minus the product of (1 - score) over its trusted patterns, and is
    known once it scores ``min_score``. A pattern scores the mean over its instances, one unknown instance added, and is
    trusted with ``min_known`` known instances and a score of ``min_score``. What is known makes further patterns trusted, round after
    round, until a round adds none; scores only rise, so no pattern is lost again. Each round is written.
    """
    edges = staged(
        mentions.select(F.explode("patterns").alias("pattern"), "instance", "seed")
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed")),
        "edges",
    )
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("known"))
    # A pattern with fewer instances can never have enough that are known.
    enough = staged(edges.groupBy("pattern").count().where(F.col("count") >= min_known).select("pattern"), "enough")
    edges = staged(edges.join(enough, "pattern").join(seeds, "instance").select("pattern", "instance", "known"), "graph")
    scored = edges.withColumn("score", F.col("known").cast("double"))
    n = 0
    while True:
        patterns = (
            scored.groupBy("pattern")
            .agg(F.count_if(F.col("score") >= min_score).alias("known"), (F.sum("score") / (F.count("*") + 1)).alias("trust"))
            .where((F.col("known") >= min_known) & (F.col("trust") >= min_score))
            .select("pattern", "trust")
        )
        patterns = staged(patterns, "patterns")
        n, before = patterns.count(), n
        if n == before:
            return patterns
        # The product as a sum of logarithms; a trust below 1 is certain, as one unknown instance is added.
        doubt = edges.join(patterns, "pattern").groupBy("instance").agg(F.sum(F.log(1 - F.col("trust"))).alias("doubt"))
        scored = edges.join(doubt, "instance", "left").select(
            "pattern", F.when(F.col("known"), 1.0).otherwise(F.coalesce(1 - F.exp("doubt"), F.lit(0.0))).alias("score")
        )


def find_personal_data(
    docs: DataFrame,
    min_known: int = MIN_KNOWN,
    min_score: float = MIN_SCORE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, an array of ``start``, ``end``, ``match`` for each base kind, and ``found``.

    Base spans are leftmost matches of :data:`PATTERNS` that pass their test; places are code points. They are the
    seeds. The last word and the last two words before a seed are lexical patterns; before a seed inside a word it is the
    part of the word before it. Identifier-like tokens after the same words are further instances. The graph of patterns
    and instances is scored for all documents together, in rounds, and what is found makes further patterns trusted;
    tokens after a trusted pattern that touch no base span are ``found``. One pass over the texts gives spans and
    mentions, which are written; all else works on those. A pattern before very many instances is summed in each
    task first, and split by Spark where it is joined.

    Null and empty texts have no spans. Very long texts, tokens and words are read whole, in time that grows with their
    length. Repeated rows get the same result each and count once as instances. Ids may be null. Other columns are not
    read and may have any name. An empty table gives an empty table.
    """
    keyed = with_key(docs, id_column, text_column).select("id", "mark", "text")
    read = keyed.select("id", "mark", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])
    plain = "array<struct<start: bigint, end: bigint, match: string>>"
    read = read.select(
        "id",
        "mark",
        *[
            F.transform(k, lambda s: F.struct(s["start"], s["end"], s["match"])).cast(plain).alias(k)
            for k in KINDS
        ],
        _mentions(F.col("text"), [F.col(k) for k in KINDS]).alias("mentions"),
    )
    read = staged(read, "spans")
    mentions = read.select("id", "mark", F.explode("mentions").alias("m")).select("id", "mark", "m.*")
    trusted = _trusted(mentions, min_known, min_score)
    found = (
        mentions.where(~F.col("seed"))
        .select("id", "mark", "start", "end", "instance", F.explode("patterns").alias("pattern"))
        .join(trusted, "pattern")
        .groupBy("id", "mark")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", F.col("instance").alias("match")))).alias("found"))
    )
    return join_documents(read, found).select(
        "id", "mark", *KINDS, F.coalesce("found", F.array().cast(plain)).alias("found")
    )


def written(*kinds: str) -> Column:
    """``kind:start:end`` of the spans in these columns, in the order given, joined by commas."""

    def of(kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )

    return F.array_join(F.concat(*map(of, kinds)), ",")
