"""Secrets, scanned once per blob and rule version, and reported for every path.

Texts are addressed by their content. A ledger remembers which blobs have been scanned by which version
of which rule, with what was found; only pairs that it lacks are scanned, and the findings are joined
back to all documents that hold the blob. All of it is Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import stored

SPAN = "struct<kind: string, start: bigint, end: bigint>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters.

    A new ``version`` makes the rule scan all blobs again.
    """

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


ASSIGN = (
    "((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: In the order in which kinds that start together are listed. A shorter run of the second and third
#: would fail its least length, so it is not matched to begin with.
BASE = (
    Rule("assign", ASSIGN, group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: What ends the line that opens or closes a private key.
NAMED = "[A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
#: In such a line.
MARKER = f"-----(?:BEGIN|END) {NAMED}"
OPENS, CLOSES = "-----BEGIN", "-----END"
# A key's span goes from the line that opens it through the next marker, if that closes it. If it does not, or there is
# none, it goes on over headers and what is base64. Every expression here is flat: loops are over single characters, so
# none recurses, whatever the length of a key or of what is between its lines.
_BASE64 = "A-Za-z0-9+/"
#: Between two lines of a key, which may be indented, quoted or have its line breaks escaped.
BREAKS = "".join(map(chr, range(1, 33))) + "\\\"',>|#*-"
_BREAK = r"""\x01-\x20\\"',>|#*-"""
#: Between the lines of a header; an escaped line break leaves its letter at the beginning of the next line.
LINE_END = r"[\r\n\\]"
HEADER = r"\A[A-Za-z][A-Za-z0-9-]*:"
#: Where base64 ends: another character, a run of fewer than 16, padding within or of more than two.
NOT_BASE64 = (
    rf"[^{_BASE64}={_BREAK}]|(?:\A|[{_BREAK}])[{_BASE64}]{{1,15}}(?:[={_BREAK}]|\z)|(?:\A|[{_BREAK}])=|=[{_BASE64}]|==="
)
A_LINE = f"[{_BASE64}]{{16}}"
#: After the last full line: one or two padded ones, or one that ends the text or is alone on its line.
LAST_LINE = (
    rf"\A(?:(?:[{_BREAK}]+[{_BASE64}]*==?[{_BASE64}]*){{1,2}}|[{_BREAK}]+[{_BASE64}]+[\x01-\x20]*\z"
    rf"|\r?\n[\x20\t]*[{_BASE64}]+[\r\n])"
)
#: Formats of keys that name themselves.
OWN = (
    Rule("private_key", MARKER, version=3),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
    Rule("hosting", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + OWN


def _body(after: Column) -> Column:
    """How much of what follows an opening line belongs to its key."""
    lines = F.split(after, LINE_END, -1)
    inside = lambda line: F.btrim(line, F.lit(BREAKS))
    header = F.transform(lines, lambda line: (inside(line) == "") | F.regexp_like(inside(line), F.lit(HEADER)))
    # The first line that is neither empty nor a header; if there is none, there is no body either.
    first = F.array_position(header, False).cast("int")
    before = F.when(first > 1, F.char_length(F.array_join(F.slice(lines, 1, F.greatest(first - 1, F.lit(1))), "x")) + 1).otherwise(0)

    def of(text: Column, skipped: Column) -> Column:
        full = F.get(F.split(text, NOT_BASE64, 2), 0)
        size = F.char_length(F.rtrim(full, F.lit(BREAKS)))
        rest = F.substr(text, size + 1)
        last = F.char_length(F.regexp_extract(rest, LAST_LINE, 0))
        return F.when(F.regexp_like(full, F.lit(A_LINE)), skipped + size + last).otherwise(0)

    one = F.array(F.struct(F.substr(after, before + 1).alias("text"), before.alias("skipped")))
    return F.when(first > 0, F.get(F.transform(one, lambda x: of(x["text"], x["skipped"])), 0)).otherwise(0)


def spans(text: Column, rule: Rule) -> Column:
    """The rule's spans in code points: the text is split by the matches, and the lengths are added up."""
    none = F.array().cast(f"array<{SPAN}>")

    def found(whole: Column, gaps: Column, values: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))

        def add(state: Column, i: Column) -> Column:
            begin = state["at"] + F.char_length(F.get(gaps, i))
            after = begin + F.char_length(F.get(whole, i))
            end, kept = after, F.char_length(F.get(values, i)) >= rule.least
            if rule.pattern == MARKER:
                gap, following = F.get(gaps, i + 1), F.get(whole, i + 1)
                closed = F.coalesce(F.startswith(following, F.lit(CLOSES)), F.lit(False))
                # Another opening line ends the key, not the text.
                body = _body(F.concat(gap, F.when(following.isNull(), "").otherwise("-")))
                end = after + F.when(closed, F.char_length(gap) + F.char_length(following)).otherwise(body)
                kept = F.startswith(F.get(whole, i), F.lit(OPENS))
            span = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.cast("bigint").alias("end"))
            more = F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(after.alias("at"), more.alias("spans"))

        every = F.sequence(F.lit(0), F.size(whole) - 1)
        return F.aggregate(every, start, add, lambda state: state["spans"])

    # The arrays are made once, bound by a transform over one element.
    parts = {"whole": F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), "gaps": F.split(text, rule.pattern, -1)}
    if rule.group:
        parts["values"] = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    bound = F.array(F.struct(*(c.alias(n) for n, c in parts.items())))
    some = F.get(F.transform(bound, lambda p: found(p["whole"], p["gaps"], p["values" if rule.group else "whole"])), 0)
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), some).otherwise(none)


def blobs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__text`` (null: empty) and ``__blob``, the SHA-256 of its UTF-8."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("__text", text).withColumn("__blob", F.sha2(text, 256))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that ``ledger`` lacks for ``docs``: each blob once, with the rules that have not seen it."""
    texts = blobs(docs).select("__blob", "__text")
    # One text of each blob; copies are combined before the shuffle.
    texts = texts.groupBy("__blob").agg(F.first("__text").alias("__text"))
    if ledger is not None:
        known = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("__seen"))
        texts = texts.join(known, texts["__blob"] == known["blob"], "left").drop("blob")
    found = []
    for rule in rules:
        pair = F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version")
        seen = F.lit(False)
        if ledger is not None:
            seen = F.coalesce(F.array_contains("__seen", F.struct(*pair)), F.lit(False))
        found.append(F.when(~seen, F.struct(*pair, spans(F.col("__text"), rule).alias("spans"))))
    rows = texts.select(F.col("__blob").alias("blob"), F.explode(F.array(*found)).alias("row"))
    rows = rows.filter("row IS NOT NULL")
    return rows.select("blob", "row.rule", "row.version", "row.spans")


def findings(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, start, end), by start and then by the order of rules.

    Start and end are code points, the end exclusive. Documents without findings have an empty array.
    Only what the current versions of ``rules`` have found counts.
    """
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    current = [(F.col("rule") == r.kind) & (F.col("version") == r.version) for r in rules]
    rows = ledger.filter((F.size("spans") > 0) & reduce(or_, current))
    rows = rows.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("found"))
    ranked = F.transform("found", lambda s: F.struct(s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"]))
    ranked = F.transform(F.sort_array(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    rows = rows.select(F.col("blob").alias("__found_in"), ranked.cast(f"array<{SPAN}>").alias("__spans"))
    paths = blobs(docs).drop("__text")
    joined = paths.join(rows, F.col("__blob") == F.col("__found_in"), "left")
    none = F.array().cast(f"array<{SPAN}>")
    others = [c for c in docs.columns if c != "spans"]
    return joined.select(*others, F.coalesce("__spans", none).alias("spans"))


def find_secrets(
    docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """``docs`` with their spans, and the ledger's new rows, which belong appended to it.

    Null texts are empty and have no spans. Repeated rows are kept, and their text is scanned once.
    A column ``spans`` that ``docs`` has is replaced.
    """
    new = stored(scan(docs, ledger, rules), "ledger")
    whole = new if ledger is None else ledger.unionByName(new)
    return findings(docs, whole, rules), new


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that overlap are replaced together."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substr(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["out"], gap, F.lit(mark))
        out = F.when(span["start"] >= state["at"], fresh).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substr(text, (state["at"] + 1).cast("int")))

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)
