"""Text normalisation as column expressions. Only compatibility normalisation and full case folding leave the JVM."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CJK = "㐀-鿿"
#: Opening marks and their closing ones (fixed values).
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "《": "》"}
#: Unicode white space, as (?U)\s has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BRACKETS = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】"}


def _in_python(c: Column, one: Callable[[str], str], need: Column, plain: Column) -> Column:
    """``one`` of each text that needs it; others never leave the JVM and are ``plain``."""
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else one(v))

    return F.when(need, F.pandas_udf(run, "string")(F.when(need, c))).otherwise(plain)


def _wide(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def nfkc(c: Column) -> Column:
    return _in_python(c, lambda v: unicodedata.normalize("NFKC", v), _wide(c), c)


def unescaped(c: Column) -> Column:
    """NFKC of the text with HTML entities resolved."""
    return _in_python(c, lambda v: unicodedata.normalize("NFKC", html.unescape(v)), _wide(c) | F.contains(c, F.lit("&")), c)


def casefold(c: Column) -> Column:
    return _in_python(c, str.casefold, _wide(c), F.lower(c))


def let(c: Column, fn) -> Column:
    """fn(c) with c computed once, however often fn uses it. For values that no Python function makes."""
    return F.transform(F.array(c), fn)[0]


def blank(c: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """All Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def tidy(c: Column) -> Column:
    """Without control characters; wide and hard spaces plain; runs of blanks one; ends bare. For normalised text."""
    t = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(F.translate(t, "　 ", "  "), r"[ \t]+", " ")
    return strip(t)


def normalize_text(c: Column) -> Column:
    return tidy(unescaped(blank(c)))


def compact(c: Column) -> Column:
    return strip(F.regexp_replace(nfkc(blank(c)), r"(?U)\s+", " "))


def compact_key(c: Column) -> Column:
    """Letters, digits and CJK of normalised text, small."""
    return F.lower(F.regexp_replace(c, f"[^A-Za-z0-9{CJK}]+", ""))


def title_key(c: Column) -> Column:
    return F.regexp_replace(casefold(nfkc(blank(c))), r"(?U)[^\w]+", "")


def name_key(c: Column) -> Column:
    return casefold(strip(blank(c)))


def script_class(c: Column) -> Column:
    cjk, latin = c.rlike(f"[{CJK}]"), c.rlike("[A-Za-z]")
    return F.when(cjk & latin, "mixed").when(cjk, "cjk").when(latin, "latin").otherwise("none")


def script_switches(c: Column) -> Column:
    t = F.regexp_replace(c, f"[^A-Za-z{CJK}]+", "")
    t = F.regexp_replace(F.regexp_replace(t, "[A-Za-z]+", "L"), f"[{CJK}]+", "C")
    return F.greatest(F.length(t) - 1, F.lit(0))


def symbol_ratio(c: Column) -> Column:
    """Share of characters other than letters, digits and CJK, white space aside; 1 for nothing."""
    solid = F.length(F.regexp_replace(c, r"(?U)\s+", ""))
    useful = F.length(F.regexp_replace(c, f"[^A-Za-z0-9{CJK}]+", ""))
    return F.when(solid == 0, F.lit(1.0)).otherwise(1.0 - useful / solid)


def usable(c: Column) -> Column:
    """How many letters, digits and CJK characters."""
    return F.length(F.regexp_replace(c, f"[^A-Za-z0-9{CJK}]+", ""))


def outer_quotes_off(c: Column) -> Column:
    """One pair of outer quotes off, if neither mark stands inside."""
    def off(t: Column) -> Column:
        inner, out = strip(t.substr(F.lit(2), F.greatest(F.length(t) - 2, F.lit(0)))), None
        for a, b in QUOTES.items():
            ok = (F.length(t) >= 2) & F.startswith(t, F.lit(a)) & F.endswith(t, F.lit(b)) & (inner != "") & ~F.contains(inner, F.lit(a)) & ~F.contains(inner, F.lit(b))
            out = F.when(ok, inner) if out is None else out.when(ok, inner)
        return out.otherwise(t)

    return let(strip(c), off)


def loose_brackets_off(c: Column) -> Column:
    """All brackets at the edges without their partner off, and the white space among them: first those that open, then
    those that close. Taking off brackets of one side never gives another a partner, so one trim a side is the whole loop."""
    def lone(t: Column, pairs: dict[str, str]) -> Column:
        return F.concat(F.lit(WHITE), *[F.when(F.contains(t, F.lit(b)), F.lit("")).otherwise(F.lit(a)) for a, b in pairs.items()])

    t = let(strip(c), lambda t: F.ltrim(t, lone(t, BRACKETS)))
    return let(t, lambda t: F.rtrim(t, lone(t, {b: a for a, b in BRACKETS.items()})))


def join_unique(cols: list[Column], sep: str = "\n") -> Column:
    """Different non-empty values in order, joined."""
    return F.array_join(F.array_distinct(F.filter(F.array(*cols), lambda x: x != "")), sep)


def first_line(c: Column) -> Column:
    return F.split(blank(c), "\n")[0]


def units(c: Column) -> Column:
    """Distinct lexical units of small normalised text: CJK pairs (a lone character itself), words and numbers."""
    han = F.regexp_replace(c, f"[^{CJK}]+", "")
    two = F.when(F.length(han) >= 2, F.transform(F.sequence(F.lit(1), F.greatest(F.length(han) - 1, F.lit(1))), lambda i: F.substr(han, i, F.lit(2)))).when(F.length(han) == 1, F.array(han)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(two, F.regexp_extract_all(c, F.lit(r"[a-z][a-z0-9_-]+|[0-9]+(?:\.[0-9]+)?"), F.lit(0))))


def grounding(out: Column, source: Column, threshold: float) -> Column:
    """struct<valid, changed, overlap> of a compact output against its compact source."""
    a, b = units(F.lower(out)), units(F.lower(source))
    share = F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))
    hit = F.contains(compact_key(source), compact_key(out))
    return F.when(out == "", F.struct(F.lit(True).alias("valid"), F.lit(False).alias("changed"), F.lit(1.0).alias("overlap"))).otherwise(F.struct((share >= threshold).alias("valid"), (~hit).alias("changed"), F.bround(share, 4).alias("overlap")))


def publication_year(c: Column) -> Column:
    """The first year 1500 to 2199 that is not part of a longer number."""
    return F.regexp_extract(blank(c), r"(?<![0-9])(1[5-9][0-9]{2}|2[01][0-9]{2})(?![0-9])", 1).try_cast("int")


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The names of all conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def first_reason(*pairs: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first condition that holds."""
    out = None
    for c, n in pairs:
        out = F.when(c, n) if out is None else out.when(c, n)
    return out.otherwise(F.lit(otherwise)) if otherwise is not None else out


def _known(terms: list[str]) -> list[str]:
    """Normalised terms, longest first."""
    return sorted({unicodedata.normalize("NFKC", t).casefold().strip() for t in terms if t.strip()}, key=lambda t: (-len(t), t))


def _one_term(term: str, longer: list[str] = ()) -> str:
    """A term's pattern, a plain ASCII term only as a whole word; not where a longer term begins that it opens."""
    quoted = lambda t: "".join("\\" + c if c in r".\+*?[^]$(){}=!<>|:-#&/~" else c for c in t)
    edges = lambda t: ("(?<![a-z0-9])", "(?![a-z0-9])") if t.isascii() and t[:1].isalnum() else ("", "")
    left, right = edges(term)
    return left + quoted(term) + "".join(f"(?!{quoted(x[len(term) :])}{edges(x)[1]})" for x in longer) + right


def term_pattern(terms: list[str]) -> str:
    """One pattern of all terms, longest first."""
    return "|".join(map(_one_term, _known(terms)))


def term_hits(c: Column, terms: list[str]) -> Column:
    """Distinct terms in a small normalised text, overlapping ones too, longer ones first; at one place only the longest
    counts. A plain search tells most texts off; only where it finds a term its surroundings are looked at."""
    known = _known(terms)
    hits = [F.when(F.contains(c, F.lit(t)) & c.rlike(_one_term(t, [x for x in known if x.startswith(t) and x != t])), F.lit(t)) for t in known]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def _each_replaced(c: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Every match of a pattern (none empty) as ``new`` of it."""
    def put(t: Column) -> Column:
        between, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size(found)), found, lambda x, m: F.concat(x, new(m))), ""), F.element_at(between, -1))

    return let(c, lambda t: F.when(t.rlike(pattern), put(t)).otherwise(t))


def cap_repeats(c: Column, least: int = 8) -> Column:
    """Runs of one character and long base64 shortened to a marker that keeps the run's length."""
    n = lambda m: F.length(m).cast("string")
    t = _each_replaced(c, r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{200,}+={0,2}", lambda m: F.concat(F.lit("[base64:"), n(m), F.lit("]")))
    plain = lambda m: F.substring(m, 1, 1).rlike(r"(?U)[\s\d\x1c-\x1f]")
    return _each_replaced(t, r"(?s)(.)\1{%d,}+" % (least - 1), lambda m: F.when(plain(m), m).otherwise(F.concat(F.substring(m, 1, 1), F.lit("[x"), n(m), F.lit("]"))))
