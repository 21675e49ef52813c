"""Text expressions: cleaning, sentences, words, n-grams, prompts. All run inside the JVM."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalis.functions.scalars import let

# fixed values: the ASCII punctuation marks; the characters that count as digits
PUNCTUATION = r"[!-/:-@\[-`{-~]"
DIGITS = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"
WORD = r"[\p{L}\p{N}_]+"
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\f\r]"
TERM = r"[\p{L}\p{N}_]{2,}"
_MARK = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_field(column: Column | str, separator: str, position: int) -> Column:
    """The 1-based field of a delimited string (from the end if negative), null if there is none."""
    return F.try_element_at(F.split(_col(column), f"\\Q{separator}\\E"), F.lit(position))


def file_stem(path: Column | str) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(F.regexp_replace(_col(path), r"^.*/", ""), r"(.)\.[^.]*$", "$1")


def parent_name(path: Column | str) -> Column:
    """Name of the folder a file lies in."""
    return split_field(path, "/", -2)


def clean_text(column: Column | str) -> Column:
    """Delete punctuation, then digits, then lower the case."""
    return F.lower(F.regexp_replace(F.regexp_replace(_col(column), PUNCTUATION, ""), DIGITS, ""))


def sentences(column: Column | str) -> Column:
    """Sentences: cut after . ! ? where white space follows; empty ones are left out."""
    marked = F.regexp_replace(_col(column), r"([.!?])[ \t\n\f\r]+", "$1" + _MARK)
    return F.filter(F.split(marked, _MARK), lambda s: F.length(F.trim(s)) > 0)


def words(column: Column | str) -> Column:
    """Words and punctuation marks, in order."""
    return F.regexp_extract_all(_col(column), F.lit(WORD_OR_MARK), F.lit(0))


def terms(column: Column | str) -> Column:
    """Lower-case terms of at least two letters, digits or underscores, of any script."""
    return F.regexp_extract_all(F.lower(_col(column)), F.lit(TERM), F.lit(0))


def edge_sentences(column: Column | str) -> Column:
    """The first and the second-to-last sentence.

    One sentence alone has no second-to-last; of two sentences the first is both.
    """
    found = _col(column)
    first = F.slice(found, 1, 1)
    late = F.when(F.size(found) >= 2, F.slice(found, F.greatest(F.size(found) - 1, F.lit(1)), 1))
    return F.concat(first, F.coalesce(late, F.array().cast("array<string>")))


def ngrams(tokens: Column | str, lengths: Sequence[int]) -> Column:
    """All n-grams of a token array for the given lengths, words joined by a blank.

    A null token is a gap: no n-gram reaches over it.
    """

    def up_to(t: Column, n: int) -> list[Column]:
        found = [t]
        for length in range(2, n + 1):  # each gram is the shorter gram at its place and the word after it
            count = F.greatest(F.size(t) - (length - 1), F.lit(0))
            heads, tails = F.slice(found[-1], F.lit(1), count), F.slice(t, F.lit(length), count)
            found.append(F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(" "), b)))
        return found

    def of(t: Column) -> Column:
        grams = up_to(t, max(lengths))
        return F.array_compact(F.concat(*[grams[n - 1] for n in lengths]))

    return let(_col(tokens), of)


def noun_base(token: Column) -> Column:
    """Singular of a regular English noun by its ending."""
    return (
        F.when(F.length(token) <= 3, token)
        .when(token.rlike("(ss|us|is)$"), token)
        .when(token.rlike("men$"), F.regexp_replace(token, "men$", "man"))
        .when(token.rlike("(ch|sh|x|z|ss)es$"), F.regexp_replace(token, "es$", ""))
        .when(token.rlike("ies$"), F.regexp_replace(token, "ies$", "y"))
        .when(token.rlike("s$"), F.regexp_replace(token, "s$", ""))
        .otherwise(token)
    )


def lemmatize_nouns(tokens: Column | str, exceptions: Mapping[str, str], max_exceptions: int = 1000) -> Column:
    """Base form per token: a listed exception, else the ending rule."""
    if len(exceptions) > max_exceptions:
        raise ValueError(f"{len(exceptions)} exceptions are too many for an expression")
    known = F.create_map(*[F.lit(x) for pair in exceptions.items() for x in pair])
    return F.transform(_col(tokens), lambda t: F.coalesce(F.try_element_at(known, t), noun_base(t)))


def render_prompt(template: str, fields: Mapping[str, Column | str]) -> Column:
    """Fill the ``{name}`` fields of a template; a field without a value is an error here, not at run time."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in fields:
                raise ValueError(f"template field {name!r} has no value; given: {sorted(fields)}")
            parts.append(F.coalesce(_col(fields[name]).cast("string"), F.lit("")))
    return F.concat(*parts)
