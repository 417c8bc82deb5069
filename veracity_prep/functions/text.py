"""Text cleaning, tokenization and stopword removal as native column expressions.

Character classes are spelled out, because Java's short classes are ASCII-only by default and differ from the
Unicode meaning of "word", "digit" and "space" that the results must follow: a word character is a letter, a
number or ``_``; a space is any Unicode white space or one of the four separators U+001C..U+001F.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from veracity_prep.options import TextOptions

_WORD = r"\p{L}\p{N}_"
_TOKEN_WORD = r"\p{L}\p{N}\p{M}_"
_SPACE = r"\s\x1c-\x1f"

# Content of these elements is not text: raw elements run to the end of the document when unclosed.
_RAW_ELEMENTS = "script|style"
_HIDDEN_ELEMENTS = "template|rt|rp"
_NON_TEXT = (
    r"(?isU)<!--.*?(?:-->|\z)"
    rf"|<({_RAW_ELEMENTS})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
    rf"|<({_HIDDEN_ELEMENTS})(?=[\s/>])[^>]*>.*?</\2\s*>"
)
# A start tag may hold ``>`` inside quoted attribute values; the second pattern takes what has unbalanced quotes. The
# possessive group doesn't recurse in the regex engine, however many attributes there are.
_QUOTED_TAG = r"""<[A-Za-z_:][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
_PLAIN_TAG = r"</?[A-Za-z_:][^>]*>|</?[!?][^>]*>"
_ENTITY = r"&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;"

_URL = rf"(?U)https?://[^{_SPACE}]+|www\.[^{_SPACE}]+"
# A run of non-spaces with an inner "@" is replaced whole, so the match is anchored at the start of the run:
# linear, where the unanchored form is quadratic in the length of runs without "@".
_EMAIL = rf"(?U)(?<![^{_SPACE}])[^{_SPACE}][^{_SPACE}@]*+@[^{_SPACE}]+"
# The digit comes first: a look-behind in front would run at every character.
_NUMBER = rf"\p{{Nd}}(?<![{_WORD}]\p{{Nd}})\p{{Nd}}*+(?![{_WORD}])"
_BLANKS = rf"(?U)[{_SPACE}]+"

_TOKEN = rf"(?U)[{_TOKEN_WORD}]+|[^{_TOKEN_WORD}{_SPACE}]"
_END = rf"(?![{_TOKEN_WORD}])"
# English words that are two tokens, cut where the bar stands, and clitics.
SPLIT_WORDS = ("can|not", "gim|me", "gon|na", "got|ta", "lem|me", "wan|na")
CLITICS = ("s", "m", "d", "ll", "re", "ve", "n")
# The rules of the lexer; the first that matches at a place wins.
_RULES = (
    r"``|''",  # double quotation marks, told apart before
    r"\.\.\.|--",
    "|".join("{0}(?={1}{2})".format(*w.split("|"), _END) for w in SPLIT_WORDS),
    rf"d'(?=ye{_END})|'t(?=(?:is|was){_END})",
    rf"[{_TOKEN_WORD}]+?(?=n't{_END})|n't{_END}",
    rf"'(?:{'|'.join(CLITICS)}){_END}",
    rf"[{_TOKEN_WORD}]+",
    rf"[^{_TOKEN_WORD}{_SPACE}]",
)
_RULED_TOKEN = "(?iU)" + "|".join(_RULES)
# What a text must hold for a rule beyond words and marks to apply.
_TRIGGERS = ("'", '"', "``", "...", "--")
# A double quotation mark opens at the start, after white space and after an opening bracket.
_OPENING = rf'(?U)(?<![^{_SPACE}(\[{{<])"'

# The English stopwords, lower case.
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being have has had having
    do does did doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again further
    then once here there when where why how all any both each few more most other some such no nor not only
    own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren
    aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't
    wouldn wouldn't
    """.split()
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often the body mentions it.

    Inside a branch of a condition Spark does not share common subexpressions by itself. ``body`` must not mention
    the variable of an enclosing ``bind``: a Python job over such an expression may fail to be planned.
    """
    return F.transform(F.array(value), body)[0]


def as_text(c: Column) -> Column:
    """NULL becomes the empty string, anything else its string form."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _numeric_reference(ref: Column) -> Column:
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9A-Fa-f]*);?$", 1)
    number = F.when(F.lower(F.substring(ref, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    code = F.when(F.length(digits) == 0, F.lit(0)).when(F.length(digits) <= 7, number)

    def char(n: Column) -> Column:
        allowed = (
            n.isin(9, 10, 13) | n.between(0x20, 0xD7FF) | n.between(0xE000, 0xFFFD) | n.between(0x10000, 0x10FFFF)
        )
        return F.when(allowed, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(F.lit(""))

    return bind(code, char)


def decode_entities(c: Column) -> Column:
    """Replace numeric references and the HTML 4 named entities in one left-to-right pass."""
    codes = dict(sorted(name2codepoint.items()), apos=ord("'"))
    # One literal that Catalyst folds into a map, instead of one literal for each entry.
    pairs = "\n".join(f"&{name};\t{chr(code)}" for name, code in codes.items())
    names = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))

    def one(ref: Column) -> Column:
        named = F.coalesce(F.try_element_at(names, ref), ref)
        return F.when(ref.startswith("&#"), _numeric_reference(ref)).otherwise(named)

    def decoded(text: Column) -> Column:
        pieces = F.split(text, _ENTITY, -1)
        refs = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
        joined = F.array_join(
            F.zip_with(pieces, refs, lambda p, r: F.when(r.isNull(), p).otherwise(F.concat(p, one(r)))), ""
        )
        return F.when(text.contains("&"), joined).otherwise(text)

    return bind(c, decoded)


def strip_html(c: Column) -> Column:
    """Visible text of an HTML document, text nodes separated by a blank; text without tags is left alone."""
    text = F.regexp_replace(c, _NON_TEXT, " ")
    text = F.regexp_replace(text, _QUOTED_TAG, " ")
    text = F.regexp_replace(text, _PLAIN_TAG, " ")
    return F.when(c.contains("<") & c.contains(">"), decode_entities(text)).otherwise(c)


def replace_urls(c: Column) -> Column:
    """Web addresses become ``[URL]``. Most texts hold none, which a plain search finds faster than the pattern."""

    def replaced(text: Column) -> Column:
        likely = text.contains("http") | text.contains("www.")
        return F.when(likely, F.regexp_replace(text, _URL, "[URL]")).otherwise(text)

    return bind(c, replaced)


def replace_emails(c: Column) -> Column:
    """Non-space runs around ``@`` become ``[EMAIL]``."""

    def replaced(text: Column) -> Column:
        return F.when(text.contains("@"), F.regexp_replace(text, _EMAIL, "[EMAIL]")).otherwise(text)

    return bind(c, replaced)


def replace_numbers(c: Column) -> Column:
    return F.regexp_replace(c, _NUMBER, "[NUMBER]")


def collapse_whitespace(c: Column) -> Column:
    """Runs of white space become one blank; blanks at both ends go."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def strip_space(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(c, rf"(?U)^[{_SPACE}]+|[{_SPACE}]+\z", "")


def clean_text(c: Column) -> Column:
    """The whole cleaning sequence: null, HTML, URLs, e-mail addresses, numbers, white space."""
    text = strip_html(as_text(c))
    return collapse_whitespace(replace_numbers(replace_emails(replace_urls(text))))


def tokenize(c: Column, split_contractions: bool = True) -> Column:
    """Words and single punctuation marks, in order.

    Unless ``split_contractions`` is off, English clitics are tokens of their own (``do`` ``n't``, ``it`` ``'s``), a few
    words are two (``can`` ``not``, ``gon`` ``na``), three full stops and two hyphens are one, and a double quotation
    mark becomes two back-quotes where it opens and two apostrophes where it closes.
    """

    def found(text: Column) -> Column:
        # Most texts hold nothing that a rule waits for, and the plain pattern is faster.
        plain = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
        quoted = F.replace(F.regexp_replace(text, _OPENING, "``"), F.lit('"'), F.lit("''"))
        ruled = F.regexp_extract_all(quoted, F.lit(_RULED_TOKEN), F.lit(0))
        words = [F.lower(text).contains(w.replace("|", "")) for w in SPLIT_WORDS]
        return F.when(reduce(or_, [*map(text.contains, _TRIGGERS), *words]), ruled).otherwise(plain)

    return bind(c, found) if split_contractions else F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0))


def stopword_list(options: TextOptions) -> tuple[str, ...]:
    """The words to drop: the given ones, the English list above, or Spark's list of the language."""
    if options.stopwords is not None:
        return options.stopwords
    if options.language == "english":
        return ENGLISH_STOPWORDS
    SparkSession.builder.getOrCreate()
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(options.language))


def drop_stopwords(tokens: Column, words: tuple[str, ...]) -> Column:
    """Keep the tokens whose lower-case form is not one of ``words``."""
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~F.lower(t).isin(*words))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def truncate(c: Column, max_length: int = 512) -> Column:
    """The first ``4 * max_length`` characters."""
    return F.substring(c, 1, 4 * max_length)
