"""Commit-message text as SQL expressions: subjects, trailers, people and reverts.

Functions take the SQL text of a string expression (usually a column name) and come in two
forms: ``trailers("message")`` gives a Column, ``trailers_sql("message")`` the expression
text, for use inside a larger one. Expression text is used because these parses nest deeply:
the parser builds them in one step where chained Column calls would each cross to the JVM.

All of it stays in the JVM. Intermediate values are bound with :func:`let`, so each step is
evaluated once per row and an expression stays linear in size however often a value is used.
Nothing is cut: whole messages are parsed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aftermerge.functions.patterns import WS, WS_CHARS, own

TRAILER_TYPE = "array<struct<key:string,value:string>>"

_BLANK_LINE = own(rf"\n[{WS}]*\n")
# Greedy from the end: what follows the last blank line. Empty when there is none.
_LAST_PARAGRAPH = own(rf"(?s)^.*\n[{WS}]*\n(.*)$")
_KEY = r"[A-Za-z0-9][A-Za-z0-9-]*"
_CHERRY_PICK = own(r"^\(cherry picked from commit [0-9a-fA-F]{7,64}\)$")
_BLOCK_START = own(rf"^(?:{_KEY}[{WS}]*:|\(cherry picked from commit )")
_NOT_FOLDED = own(rf"^[^{WS}]")
_HAS_FOLD = own(rf"\n[{WS}]")
_BLOCK_LINE = own(rf"^(?:[{WS}]|{_KEY}[{WS}]*:)")
_FOLD = own(rf"(?<![{WS}])[{WS}]*\n[{WS}]+")
_TRAILER = own(rf"^({_KEY})[{WS}]*:[{WS}]*(.*)$")
_PERSON = own(rf"^[{WS}]*(.*?)[{WS}]*<([^<>]+)>[{WS}]*$")
_UNDO = own(rf'^(Revert|Reapply)[{WS}]+"((?s:.*))"(?:[{WS}]+\(#(\d+)\))?[{WS}]*$')
_UNDO_PREFIX = r"^Re(?:vert|apply)"
_UNDONE_SHA = own(r"This reverts commit ([0-9a-fA-F]{7,40})\b")
_UNDONE_PR = own(rf"(?m)^Reverts[{WS}]+(?:[\w.-]+/[\w.-]+)?#(\d+)[{WS}]*$")
_TRAILING_PR = own(rf"\(#(\d+)\)[{WS}]*$")
_COARSE_UNDO = r'^(?:Revert|Reapply) "'


def quote(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_SPACE = quote(WS_CHARS)
_NO_TRAILERS = f"CAST(array() AS {TRAILER_TYPE})"


def strip_sql(text: str) -> str:
    """Python's ``str.strip``: all Unicode white space, both ends."""
    return f"trim(BOTH {_SPACE} FROM {text})"


def normalise_sql(message: str) -> str:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``; trailing white space goes."""
    unix = f"replace(replace({message}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"trim(TRAILING {_SPACE} FROM {unix})"


def _stripped_left(message: str) -> str:
    return f"trim(LEADING {_SPACE} FROM {normalise_sql(message)})"


def subject_sql(message: str) -> str:
    """First line of the message, stripped; '' for a blank message, NULL for NULL."""
    return strip_sql(f"substring_index({_stripped_left(message)}, chr(10), 1)")


def trailers_sql(message: str) -> str:
    """Trailer block of the message as ``array<struct<key,value>>``, in order.

    Only a last paragraph made wholly of ``Key: value`` lines, their folded continuations and
    cherry-pick notes counts. Anything else, or a one-paragraph message, gives an empty array.
    """
    block = let(_lines_sql("b"), "ls", _block_sql("ls"))
    # Prose is told by its first line, before it is cut into lines.
    last = let(
        f"regexp_extract(t, {quote(_LAST_PARAGRAPH)}, 1)",
        "b",
        f"CASE WHEN b RLIKE {quote(_BLOCK_START)} THEN {block} ELSE {_NO_TRAILERS} END",
    )
    # A single line cannot hold a second paragraph: most messages end here.
    body = f"CASE WHEN contains(t, chr(10)) THEN {last} ELSE {_NO_TRAILERS} END"
    return f"CASE WHEN {message} IS NOT NULL THEN {let(normalise_sql(message), 't', body)} END"


def _lines_sql(block: str) -> str:
    """The lines of a last paragraph, cherry-pick notes left out."""
    return f"filter(split({block}, chr(10), -1), l -> NOT l RLIKE {quote(_CHERRY_PICK)})"


def _block_sql(lines: str) -> str:
    joined = f"CASE WHEN j RLIKE {quote(_HAS_FOLD)} THEN regexp_replace(j, {quote(_FOLD)}, ' ') ELSE j END"
    value = strip_sql(f"regexp_extract(l, {quote(_TRAILER)}, 2)")
    pair = f"struct(regexp_extract(l, {quote(_TRAILER)}, 1) AS key, {value} AS value)"
    parsed = let(
        f"array_join({lines}, chr(10))", "j", f"transform(split({joined}, chr(10), -1), l -> {pair})"
    )
    is_block = (
        f"size({lines}) > 0 AND get({lines}, 0) RLIKE {quote(_NOT_FOLDED)}"
        f" AND forall({lines}, l -> l RLIKE {quote(_BLOCK_LINE)})"
    )
    return f"CASE WHEN {is_block} THEN {parsed} ELSE {_NO_TRAILERS} END"


def trailer_steps(message: str, wanted: str) -> list[str]:
    """:func:`trailers_sql` as columns, each made of those before it; the last is ``_pairs``.

    Messages that are not ``wanted`` (a condition) have no pairs. Steps of their own are compiled,
    where the body of a :func:`let` is evaluated expression by expression.
    """
    last = f"regexp_extract(_text, {quote(_LAST_PARAGRAPH)}, 1)"
    noted = f"CASE WHEN contains(_last, '(cherry') THEN {_lines_sql('_last')} ELSE split(_last, chr(10), -1) END"
    return [
        f"CASE WHEN {wanted} THEN {normalise_sql(message)} END AS _text",
        f"CASE WHEN contains(_text, chr(10)) THEN {last} END AS _last",
        f"CASE WHEN _last RLIKE {quote(_BLOCK_START)} THEN {noted} END AS _lines",
        f"CASE WHEN _lines IS NOT NULL THEN {_block_sql('_lines')} ELSE {_NO_TRAILERS} END AS _pairs",
    ]


def trailer_values_sql(message: str, key: str) -> str:
    """Values of every trailer with that key (any case), in order."""
    wanted = f"filter({trailers_sql(message)}, f -> lower(f.key) = {quote(key.lower())})"
    return f"transform({wanted}, f -> f.value)"


def person_sql(value: str) -> str:
    """``Name <email>`` as ``struct<name,email>``; NULL when the shape does not fit."""
    email = strip_sql(f"regexp_extract({value}, {quote(_PERSON)}, 2)")
    parts = f"struct(regexp_extract({value}, {quote(_PERSON)}, 1) AS name, {email} AS email)"
    return f"CASE WHEN {value} RLIKE {quote(_PERSON)} THEN {parts} END"


def coarse_revert_sql(message: str) -> str:
    """The scan-level revert test: the raw message starts ``Revert "`` or ``Reapply "``."""
    return f"coalesce({message} RLIKE {quote(_COARSE_UNDO)}, false)"


def revert_sql(message: str) -> str:
    """What a revert or reapply commit says it undoes, as a struct; NULL for other messages."""

    def found(pattern: str, text: str, group: int = 1) -> str:
        return f"nullif(regexp_extract({text}, {quote(pattern)}, {group}), '')"

    quoted = strip_sql(f"regexp_extract(h, {quote(_UNDO)}, 2)")
    number = f"coalesce({found(_UNDONE_PR, 'b')}, {found(_TRAILING_PR, quoted)})"
    fields = (
        f"struct(regexp_extract(h, {quote(_UNDO)}, 1) = 'Reapply' AS is_reapply,"
        f" {quoted} AS original_subject, lower({found(_UNDONE_SHA, 'b')}) AS reverted_sha,"
        f" try_cast({number} AS BIGINT) AS original_pr_number,"
        f" try_cast({found(_UNDO, 'h', 3)} AS BIGINT) AS revert_pr_number)"
    )
    undo = f"CASE WHEN h RLIKE {quote(_UNDO)} THEN {fields} END"
    head = strip_sql("replace(get(ps, 0), chr(10), ' ')")
    with_body = let("coalesce(get(ps, 1), '')", "b", undo)
    parsed = let(f"split(t, {quote(_BLANK_LINE)}, 2)", "ps", let(head, "h", with_body))
    # Almost no commit is a revert: a literal prefix test spares the rest the parse.
    guarded = f"CASE WHEN t RLIKE {quote(_UNDO_PREFIX)} THEN {parsed} END"
    # A search of the raw message spares nearly all the rest their normal form.
    named = f"contains({message}, 'Revert') OR contains({message}, 'Reapply')"
    return f"CASE WHEN {named} THEN {let(_stripped_left(message), 't', guarded)} END"


def strip(text: str) -> Column:
    """Column form of :func:`strip_sql`."""
    return F.expr(strip_sql(text))


def normalise(message: str) -> Column:
    """Column form of :func:`normalise_sql`."""
    return F.expr(normalise_sql(message))


def subject(message: str) -> Column:
    """Column form of :func:`subject_sql`."""
    return F.expr(subject_sql(message))


def trailers(message: str) -> Column:
    """Column form of :func:`trailers_sql`."""
    return F.expr(trailers_sql(message))


def trailer_values(message: str, key: str) -> Column:
    """Column form of :func:`trailer_values_sql`."""
    return F.expr(trailer_values_sql(message, key))


def person(value: str) -> Column:
    """Column form of :func:`person_sql`."""
    return F.expr(person_sql(value))


def is_coarse_revert(message: str) -> Column:
    """Column form of :func:`coarse_revert_sql`."""
    return F.expr(coarse_revert_sql(message))


def revert(message: str) -> Column:
    """Column form of :func:`revert_sql`."""
    return F.expr(revert_sql(message))
