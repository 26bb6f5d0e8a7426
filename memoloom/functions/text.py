"""Lexical helpers over strings and arrays of terms, all of them within the JVM.

They take and give SQL text: a classifier's expressions have some thousand nodes, each of which would be a call from
Python to the JVM if it were built by itself. Use them in ``F.expr`` or ``selectExpr``; a plain column name will do as
an argument, and names in lambdas (``t``, ``i``, ...) mustn't be those of columns.
"""

from __future__ import annotations

_NONE = "cast(array() as array<string>)"


def clean(x: str) -> str:
    """White space collapsed and trimmed; null is ''."""
    return rf"trim(regexp_replace(coalesce({x}, ''), '(?U)\\s+', ' '))"


def low(x: str) -> str:
    return f"lower({clean(x)})"


def token_list(x: str) -> str:
    """Lower-case tokens in order, repeats included."""
    return f"filter(split({low(x)}, ' '), t -> t <> '')"


def tokens(x: str) -> str:
    """Distinct lower-case tokens between white space."""
    return f"array_distinct({token_list(x)})"


def term_list(terms: str, most: int) -> str:
    """Cleaned non-blank terms, the first of those that differ in case alone, at most ``most``."""
    cleaned = f"filter(transform(coalesce({terms}, {_NONE}), t -> {clean('t')}), t -> t <> '')"
    firsts = "filter(all_, (t, i) -> array_position(lows, get(lows, i)) = i + 1)"
    return f"slice({_let(cleaned, 'all_', _let('transform(all_, t -> lower(t))', 'lows', firsts))}, 1, {most})"


def low_terms(terms: str) -> str:
    """Terms in lower case and cleaned, blanks dropped: what the tests below compare with."""
    return f"filter(transform({terms}, t -> {low('t')}), t -> t <> '')"


def has_any(text: str, terms: str) -> str:
    """Whether any of the terms is a substring; text and terms are prepared."""
    return f"exists({terms}, q -> contains({text}, q))"


def phrase(x: str) -> str:
    """Lower-case words joined by single spaces, anything else dropped."""
    return rf"trim(regexp_replace({low(x)}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+', ' '))"


def spaced(words: str) -> str:
    """A phrase with a space of its own on either side of each word, so that matches never share one."""
    return f"concat(' ', replace({words}, ' ', '  '), ' ')"


def by_length(terms: str) -> str:
    """The longest first, then by name."""
    return f"transform(array_sort(transform({terms}, t -> struct(-length(t) as n, t as t))), s -> s.t)"


def phrases(terms: str) -> str:
    """Terms as spaced phrases, the longest first, blanks dropped."""
    made = f"filter(transform({terms}, t -> {phrase('t')}), t -> t <> '')"
    return f"transform({by_length(made)}, t -> {spaced('t')})"


def remove_phrases(x: str, terms: str) -> str:
    """The text as a phrase, without any of the terms; longer terms go first."""
    return without(spaced(phrase(x)), phrases(terms))


def without(text: str, terms: str) -> str:
    """The same for a spaced phrase and phrases that are prepared."""
    return f"trim(regexp_replace(aggregate({terms}, {text}, (acc, t) -> replace(acc, t, '')), ' +', ' '))"


def stripped(text: str, terms: str) -> str:
    """The lower-case text without the terms where spaces surround them; terms are prepared, the longest first."""
    return clean(f"aggregate({terms}, concat(' ', {text}, ' '), (acc, t) -> replace(acc, concat(' ', t, ' '), ' '))")


def attached(x: str, targets: str, reasons: str, gap: int, reach: int = 40) -> str:
    """Whether a reason stands near a target: first places within ``reach`` characters, or tokens within ``gap``.

    A token matches a term if it contains it or is one of its words.
    """
    return near(low(x), token_list(x), low_terms(targets), low_terms(reasons), gap, reach)


def near(text: str, words: str, targets: str, reasons: str, gap: int, reach: int = 40) -> str:
    """The same for a text, its tokens and terms that are prepared. Only terms that occur are paired."""

    def places(terms: str) -> str:
        return f"filter(transform({terms}, t -> instr({text}, t)), i -> i > 0)"

    def hits(terms: str) -> str:
        match = f"exists({terms}, t -> contains(w, t) or (contains(t, w) and array_contains(split(t, ' '), w)))"
        return f"filter(transform({words}, (w, i) -> if({match}, i, null)), i -> i is not null)"

    def meet(a: str, b: str, most: int) -> str:
        return _let(a, "aa", _let(b, "bb", f"exists(aa, i -> exists(bb, j -> abs(i - j) <= {most}))"))

    return f"({meet(places(targets), places(reasons), reach)} or {meet(hits(targets), hits(reasons), gap)})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` of a value that is computed once and called ``name`` there."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def label_tokens(x: str) -> str:
    """Tokens of a label such as ``07-01. Some/label (part)``, without its number."""
    bare = rf"regexp_replace({clean(x)}, '^\\d+-\\d+\\.\\s*', '')"
    return rf"filter(split({bare}, '(?U)[/()\\-_,\\s]+'), t -> t <> '')"


def length_bucket(x: str, short: int = 25, medium: int = 80) -> str:
    return f"case when length({x}) <= {short} then 'short' when length({x}) <= {medium} then 'medium' else 'long' end"


def json_list(x: str) -> str:
    """A JSON list of strings; any other non-blank text is a list of itself, null and blank are empty."""
    return f"case when {clean(x)} = '' then {_NONE} else coalesce(from_json({x}, 'array<string>'), array({x})) end"
