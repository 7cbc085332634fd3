"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

The base kinds are email, ip, card and phone; a card passes the Luhn test. A base pattern takes
as much as it can, so a number that stands next to another one fails with it. The method adds
tel and pan, telephone and card numbers in their usual grouping, for these; iban, whose letters
and digits must leave 1 modulo 97; key, the access keys of a cloud; and secret, a hexadecimal
string that counts only if a word like ``token`` stands just before it. Each span has a score:
that of its kind, raised if one of the kind's context words stands within ``NEAR`` characters
before it: of the text with ``through``, as the query and the pipeline have it, else only of
what follows the kind's last match. Base spans stay whatever their score; added ones need ``least``, and to lie in no
base span.

Spark's own functions only. A pattern's matches and the pieces between them give the places:
both come from the same left-to-right search. The patterns are written so that a failed try
isn't repeated from every later character of the same run, which changes no match. Texts full of
matches cost little more than in proportion: see ``_scan``.

Defined cases: a null or empty text has no spans. Places count code points. Spans of one kind
don't overlap; those of different kinds may, and are all listed. ``redacted`` puts one mark for
spans that overlap, that of the first. Columns beyond the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters before a span in which a context word counts, and what it adds to the score.
NEAR, RAISE = 40, 0.3

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


class Kind(NamedTuple):
    """name; pattern; a string that any match contains (else ""); what confirms a match;
    score; context words, as a pattern over lower-cased text; whether it is a base kind."""

    name: str
    pattern: str
    sign: str
    confirms: Callable[[Column], Column]
    score: float
    context: str
    base: bool


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column) -> Column:
    return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))


def _iban(value: Column) -> Column:
    """Whether the number, its first four characters put last and letters read as 10 to 35,
    leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4))

    def further(rest: Column, sign: Column) -> Column:
        letter = rest * 100 + F.ascii(sign) - 55
        return F.when(sign.between("0", "9"), rest * 10 + F.ascii(sign) - 48).otherwise(letter) % 97

    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), further) == 1)


KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", lambda value: F.lit(True), 0.7, "mail|contact|write", True,
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "", lambda value: value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, r"\bip\b|host|server|address", True,
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", _card, 0.7, "card|visa|pay|credit", True),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
        "+", lambda value: F.length(_digits(value)).between(9, 15), 0.6, "phone|call|tel|fax|mobile", True,
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "", _iban, 0.7, "iban|bank|account", False,
    ),
    Kind(
        "tel", r"\+[0-9]{1,3}[\x20-]?\(?[0-9]{2,4}\)?[\x20-]?[0-9]{3,4}[\x20-][0-9]{4}(?![0-9])",
        "+", lambda value: F.length(_digits(value)).between(9, 15), 0.6, "phone|call|tel|fax|mobile", False,
    ),
    Kind(
        "pan", r"(?<![0-9])(?:[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{13,19})(?![0-9])",
        "", _card, 0.7, "card|visa|pay|credit", False,
    ),
    Kind("key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])", "AKIA", lambda value: F.lit(True), 0.7, "key|access", False),
    Kind(
        "secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{16,128}(?![A-Za-z0-9])",
        "", lambda value: F.lit(True), 0.3, "token|secret|key|password|passwd|credential", False,
    ),
)


_SPAN = "struct<start:int,order:int,end:int,kind:string,score:double,base:boolean>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(items: Column, begin: Column, step: Callable, emit: Callable, kind: str) -> Column:
    """What ``emit(state, item)`` gives for each item (an array of ``kind``), one after the other,
    where ``step(state, item)`` is the state that the next item meets.

    Growing one array item by item would copy it as often as it has items. Here items are in
    blocks, about as many as a block has items: first the state that each block begins with,
    then each block's own short array.
    """
    none = F.array().cast(f"array<{kind}>")

    def of_block(state: Column, block: Column) -> Column:
        more = lambda acc, item: F.struct(step(acc["state"], item).alias("state"), F.concat(acc["out"], emit(acc["state"], item)).alias("out"))
        return F.aggregate(block, F.struct(state.alias("state"), none.alias("out")), more, lambda acc: acc["out"])

    def whole(items: Column) -> Column:
        size = F.greatest(F.lit(32), F.ceil(F.sqrt(F.size(items)))).cast("int")

        def in_blocks(size: Column) -> Column:
            count = F.ceil(F.size(items) / size).cast("int")
            return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(items, k * size + 1, size))

        def joined(blocks: Column) -> Column:
            first = F.struct(begin.alias("state"), F.array(begin).alias("states"))
            after = lambda acc, block: F.aggregate(block, acc["state"], step)
            states = F.aggregate(
                blocks, first,
                lambda acc, block: _let(after(acc, block), lambda state: F.struct(state.alias("state"), F.concat(acc["states"], F.array(state)).alias("states"))),
                lambda acc: F.slice(acc["states"], 1, F.size(blocks)),
            )
            return F.flatten(F.zip_with(blocks, states, lambda block, state: of_block(state, block)))

        return F.when(F.size(items) > 0, _let(_let(size, in_blocks), joined)).otherwise(none)

    return _let(items, whole)


def _matches(text: Column, kind: Kind, order: int, through: bool) -> Column:
    """The confirmed spans of a kind: start, order, end, kind, score, base."""
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    # The piece after the last match has none of its own.
    pairs = F.filter(
        F.zip_with(pieces, values, lambda piece, value: F.struct(piece.alias("piece"), value.alias("value"))),
        lambda pair: pair["value"].isNotNull(),
    )

    def before(state: Column, pair: Column) -> Column:
        return F.concat(state["last"], pair["piece"]) if through else pair["piece"]

    def step(state: Column, pair: Column) -> Column:
        end = state["end"] + F.char_length(pair["piece"]) + F.char_length(pair["value"])
        more = [F.substring(F.concat(before(state, pair), pair["value"]), -NEAR, NEAR).alias("last")] if through else []
        return F.struct(end.alias("end"), *more)

    def emit(state: Column, pair: Column) -> Column:
        start = state["end"] + F.char_length(pair["piece"])
        near = F.lower(F.substring(before(state, pair), -NEAR, NEAR))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), F.lit(RAISE)).otherwise(F.lit(0.0))
        one = F.struct(
            start.alias("start"), F.lit(order).alias("order"), (start + F.char_length(pair["value"])).alias("end"),
            F.lit(kind.name).alias("kind"), score.alias("score"), F.lit(kind.base).alias("base"),
        )
        return F.when(kind.confirms(pair["value"]), F.array(one)).otherwise(nothing)

    nothing = F.array().cast(f"array<{_SPAN}>")
    begin = F.struct(F.lit(0).alias("end"), *([F.lit("").alias("last")] if through else []))
    possible = text.contains(kind.sign) if kind.sign else text.rlike(kind.pattern)
    return F.when(possible, _scan(pairs, begin, step, emit, _SPAN)).otherwise(nothing)


def spans(text: Column, least: float = 0.5, through: bool = False) -> Column:
    """All spans of a text, by start and then in the order of ``KINDS``. ``through``: context is
    looked for through the kind's earlier matches, confirmed or not."""
    text = F.coalesce(text, F.lit(""))
    found = [(kind, _matches(text, kind, order, through)) for order, kind in enumerate(KINDS)]
    base = F.concat(*(matches for kind, matches in found if kind.base))
    added = F.filter(F.concat(*(matches for kind, matches in found if not kind.base)), lambda span: span["score"] >= least)

    def without_covered(base: Column, added: Column) -> Column:
        """The base spans, and the added ones that lie in none of them: all by start, base ones
        first, each meets the furthest end of the base spans before it."""
        furthest = lambda end, span: F.when(span["base"], F.greatest(end, span["end"])).otherwise(end)
        stays = lambda end, span: F.when(span["base"] | (end < span["end"]), F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return _scan(F.array_sort(F.concat(base, added)), F.lit(0), furthest, stays, _SPAN)

    def both(base: Column) -> Column:
        return _let(added, lambda added: F.when(F.size(added) > 0, without_covered(base, added)).otherwise(F.array_sort(base)))

    return _let(base, both)


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(found: Column) -> Column:
    return F.filter(found, lambda span: span["base"])


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda span: span["kind"] == kind)).cast("long")


#: Characters of a piece that ``redacted`` cuts a text into.
PIECE = 512


def redacted(text: Column, found: Column) -> Column:
    """The text with a mark such as [EMAIL] in place of its spans. The text is cut into pieces
    once, so that what lies between two spans is taken from the pieces there."""

    def between(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        some = F.slice(pieces, first + 1, F.greatest(F.lit(0), F.ceil(end / PIECE).cast("int") - first))
        cut = lambda piece, k: F.substring(
            piece,
            F.greatest(F.lit(0), start - (first + k) * PIECE) + 1,
            F.least(F.lit(PIECE), end - (first + k) * PIECE) - F.greatest(F.lit(0), start - (first + k) * PIECE),
        )
        return F.array_join(F.transform(some, cut), "")

    def marked(pieces: Column) -> Column:
        furthest = lambda end, span: F.greatest(end, span["end"])

        def emit(end: Column, span: Column) -> Column:
            one = F.concat(between(pieces, end, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
            return F.when(span["start"] >= end, F.array(one)).otherwise(F.array().cast("array<string>"))

        last = F.aggregate(found, F.lit(0), furthest)
        rest = _let(last, lambda last: between(pieces, last, F.char_length(text)))
        return F.concat(F.array_join(_scan(found, F.lit(0), furthest, emit, "string"), ""), rest)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(found) > 0, _let(pieces, marked)).otherwise(text)
