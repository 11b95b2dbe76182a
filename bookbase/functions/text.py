"""Text rules as Column expressions."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from bookbase.functions.bind import let

# The characters that do not separate words, as a regex class body. Stated from
# this side because most characters are then settled by the first range.
INK = (
    r"\x21-\x{84}\x{86}-\x{9f}\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}"
    r"\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}\x{00}-\x08\x0e-\x1b"
)
BLANKS = f"[^{INK}]+"

# What ends a line.
LINE_END = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

# Decimal digits of every script plus superscript, subscript and enclosed
# digits, as a regex class body.
DIGIT = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}"
    r"\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)

# Signs a catalogue text loses on cleaning.
NOISE = "[`“”():;,\\n\\r]+"

# Markers that count as a missing value in a catalogue file.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# English stop words of the common published list.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
TITLE_CASE = (
    rf"^[^{_CASED}]*[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*"
    rf"([^{_CASED}]+[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*)*[^{_CASED}]*$"
)
NAME_WORD = r"^\p{Lu}[\p{L}'’-]*\p{Ll}[\p{L}'’-]*$"
SENTENCE_END = r"[.!?:][\"'”’)\]]*$"


def stop_words(language):
    """Spark's stop list of another language, lower case; needs a running session."""
    return [w.lower() for w in StopWordsRemover.loadDefaultStopWords(language)]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Blank-separated words, none empty."""
    return F.array_remove(F.split(_col(c), BLANKS), "")


def squeeze(c) -> Column:
    """Blank runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), BLANKS, " "))


def strip(c) -> Column:
    """No blanks at the ends; inner ones stay."""
    return F.regexp_replace(_col(c), f"^{BLANKS}|{BLANKS}$", "")


def strip_dates(c) -> Column:
    """An author without years: `?` and digits go, hyphens and en dashes become blanks."""
    return squeeze(F.regexp_replace(F.translate(_col(c), "-–?", "  "), f"[{DIGIT}]", ""))


def clean_text(c) -> Column:
    """Punctuation noise and doubled single quotes become blanks; blanks collapse; lower case."""
    quiet = F.regexp_replace(F.regexp_replace(_col(c), NOISE, " "), "''", " ")
    return F.lower(squeeze(quiet))


def norm_query(c) -> Column:
    """An incoming title, author or question is compared in lower case."""
    return F.lower(_col(c))


def has_words(c) -> Column:
    """True when `clean_text` leaves something; most texts are settled by their first character."""
    plain = _col(c).rlike(f"[{INK}&&[^`“”():;,']]")
    return plain | (clean_text(c) != "")


def drop_stopwords(c, stop) -> Column:
    """Text without the words whose lower-case form is in `stop`, joined by one space."""
    return F.array_join(F.filter(words(c), lambda w: ~F.lower(w).isin(list(stop))), " ")


def keyword_tokens(c, stop) -> Column:
    """All-letter tokens in text order, lower case, stop words left out.

    A token is a run of letters, digits and underscores, so punctuation never sticks to it.
    """
    tokens = F.split(F.lower(_col(c)), r"[^\p{L}\p{N}_]+")
    return F.filter(tokens, lambda w: w.rlike(r"^\p{L}+$") & ~w.isin(list(stop)))


def title_case_tokens(c) -> Column:
    """Distinct blank-separated tokens in title case, in order of first use, punctuation kept."""
    return F.array_distinct(F.filter(words(c), lambda w: w.rlike(TITLE_CASE)))


def name_spans(c, stop) -> Column:
    """Distinct runs of two or more consecutive capitalised words: a rule for person names.

    A word that opens a sentence or is a stop word is never part of a run, and punctuation
    ends a run. This is a rule, not a model: single names and names that open a sentence
    are missed.
    """
    tokens = words(c)
    stop = list(stop)

    def mark(w, before):
        core = F.regexp_replace(w, r"^[^\p{L}]+|['’]s[^\p{L}]*$|[^\p{L}]+$", "")
        named = (
            core.rlike(NAME_WORD)
            & ~F.lower(core).isin(stop)
            & before.isNotNull()
            & ~before.rlike(SENTENCE_END)
        )
        opened = F.when(w.rlike(r"^[^\p{L}]"), F.lit("| ")).otherwise(F.lit(""))
        closed = F.when(w.rlike(r"[^\p{L}]$"), F.lit(" |")).otherwise(F.lit(""))
        return F.when(named, F.concat(opened, core, closed)).otherwise(F.lit("|"))

    # `tokens` is sliced by one to see the word before without indexing per word.
    before = F.concat(F.array(F.lit(None).cast("string")), tokens)
    pairs = F.filter(
        F.arrays_zip(tokens.alias("w"), before.alias("b")), lambda p: p["w"].isNotNull()
    )
    line = F.array_join(F.transform(pairs, lambda p: mark(p["w"], p["b"])), " ")
    return F.array_distinct(F.regexp_extract_all(line, F.lit(r"[^| ]+(?: [^| ]+)+"), F.lit(0)))


def first_lines(c, n) -> Column:
    """The first `n` lines joined by newline; all of the text when None.

    Every line ending that Unicode knows counts; one that ends the text begins no line.
    """
    if n is None:
        return _col(c)
    # The split stops after the lines asked for; what follows stays in one piece and is dropped.
    pieces = F.split(_col(c), LINE_END, n + 1)

    def taken(p):
        # A text that ends in a line ending leaves an empty last piece, which is not a line.
        lines = F.when((F.size(p) <= n) & (F.element_at(p, -1) == ""), F.size(p) - 1).otherwise(F.lit(n))
        return F.array_join(F.slice(p, F.lit(1), lines), "\n")

    return let(pieces, taken)
