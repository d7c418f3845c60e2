"""Text functions on columns. White space is Unicode white space unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Both numeric patterns are fixed values: results depend on them token by token.
STRUCTURED_NUMBER = r"(?U)(?<![\w.])(?:[<>≤≥]?\s*[-+−]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−-]?\d+)?%?)(?![\w.])"
CONTENT_NUMBER = r"(?U)[+−\-±]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−\-]?\d+)?%?"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", "")


def casefold(c: Column | str) -> Column:
    """Full case folding: upper case brings together what lower case leaves apart, such as ß and ss, and final with other sigmas."""
    # The dotless i folds to itself. Its way back stands between the two cases, which the optimiser would otherwise make one.
    upper = F.translate(F.upper(F.translate(col(c), "\u0131\u1e9e", "\ue0ff\u00df")), "\ue0ff", "\u0131")
    return F.translate(F.lower(upper), "\u03c2", "\u03c3")


def collapse(c: Column | str) -> Column:
    """Runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def squeeze_blank_lines(c: Column | str) -> Column:
    """At most one blank line in a row, stripped, with a line end."""
    return F.concat(strip(F.regexp_replace(col(c), r"\n{3,}", "\n\n")), F.lit("\n"))


def nonempty(c: Column | str) -> Column:
    """Stripped text, or null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def first_available(*values: Column | str) -> Column:
    return F.coalesce(*[nonempty(v) for v in values])


def longest_available(*values: Column | str) -> Column:
    """The longest text, the first of equally long ones."""
    best = nonempty(values[0])
    for v in values[1:]:
        other = nonempty(v)
        best = F.when(best.isNull() | (F.char_length(other) > F.char_length(best)), other).otherwise(best)
    return best


def with_period(label: Column | str) -> Column:
    c = col(label)
    return F.when(F.substring(c, -1, 1).isin(".", ":"), c).otherwise(F.concat(c, F.lit(".")))


def occurrences(c: Column | str, text: str) -> Column:
    """Non-overlapping occurrences of a fixed text."""
    return ((F.char_length(col(c)) - F.char_length(F.replace(col(c), F.lit(text), F.lit("")))) / F.lit(len(text))).cast("long")


def structured_numbers(c: Column | str) -> Column:
    """Number tokens that stand alone, with a sign, comparison or per cent sign."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(STRUCTURED_NUMBER), F.lit(0)), strip)


def content_numbers(c: Column | str) -> Column:
    """Number tokens anywhere in the text."""
    return F.regexp_extract_all(col(c), F.lit(CONTENT_NUMBER), F.lit(0))


def without_images(c: Column | str) -> Column:
    """Table content without <img> tags."""
    return F.regexp_replace(col(c), r"(?i)<img\b[^>]*>", "")


def heading_level(title: Column | str) -> Column:
    """Markdown level of a section title: the depth of its number plus one, also where the title is the number alone, 3 for a lettered note, else 2."""
    c = col(title)
    number = F.regexp_extract(c, r"(?U)^\s*(\d+(?:\.\d+)*)(?:\s|\z)", 1)
    depth = F.size(F.split(number, "[.]"))
    return F.when(number != "", F.least(depth + 1, F.lit(6))).when(c.rlike(r"(?iU)^\s*Note\s+[A-Z]\d+"), 3).otherwise(2)


def has_heading(markdown: Column | str, title: str) -> Column:
    """A heading that is exactly the title, maybe numbered."""
    return col(markdown).rlike(rf"(?miUd)^#{{1,6}}\s+(?:\d+(?:\.\d+)*\s+)?\Q{title}\E\s*$")


def has_references(markdown: Column | str) -> Column:
    return col(markdown).rlike(r"(?miUd)^#{1,6}\s+(?:References|Bibliography)\s*$")


def has_mojibake(c: Column | str) -> Column:
    x = col(c)
    return x.contains("Ã") | x.contains("Â") | x.contains("â€") | x.contains("\ufffd")


def inline_tex(c: Column | str) -> Column:
    """TeX of an inline formula: the document's body, else without its preamble; one pair of delimiters goes."""
    text = strip(c)
    inner = F.regexp_extract(text, r"(?s)\\begin\{document\}(.*?)\\end\{document\}", 1)
    plain = text
    for pattern in (r"\\documentclass(?:\[[^\]]*\])?\{[^}]*\}", r"\\usepackage(?:\[[^\]]*\])?\{[^}]*\}", r"\\setlength\{[^}]*\}\{[^}]*\}", r"\\(?:begin|end)\{document\}"):
        plain = F.regexp_replace(plain, pattern, "")
    cleaned = collapse(F.when(text.rlike(r"(?s)\\begin\{document\}.*?\\end\{document\}"), inner).otherwise(plain))
    out = cleaned
    for opening, closing in (("$", "$"), (r"\(", r"\)"), (r"\[", r"\]"), ("$$", "$$")):
        n = len(opening)
        body = strip(F.substring(cleaned, F.lit(n + 1), F.greatest(F.char_length(cleaned) - 2 * n, F.lit(0))))
        found = cleaned.startswith(opening) & cleaned.endswith(closing)
        out = F.when(found, F.when(body != "", body).otherwise(cleaned)).otherwise(out)
    return strip(out)


def date_text(year: Column | str, month: Column | str, day: Column | str, padded: bool = True) -> Column:
    """year[-month[-day]] from text parts; null without a year if padded, else of the parts there are."""
    y, m, d = (nonempty(x) for x in (year, month, day))
    if not padded:
        return F.nullif(F.concat_ws("-", y, m, d), F.lit(""))
    two = lambda x: F.when(x.rlike(r"^\d$"), F.lpad(x, 2, "0")).otherwise(x)
    return F.when(y.isNotNull(), F.concat_ws("-", y, two(m), two(d)))


def safe_long(c: Column | str) -> Column:
    """The whole number a text states, else null."""
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))
