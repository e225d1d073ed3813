"""Text expressions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of a response that is in question form.
QUESTION_PREFIXES = (
    "what is", "what are", "what was", "what were", "what's", "who is", "who are", "who was", "who were", "who's", "where is",
    "where are", "where was", "where's", "when is", "when was", "when did", "how many", "how much", "how did", "which", "name",
)
# Words that point to a person.
PERSON_WORDS = (
    "president", "king", "queen", "author", "actor", "actress", "singer", "poet", "composer", "painter", "artist", "writer", "director", "emperor",
    "general", "captain", "doctor", "pope", "saint", "mr.", "mrs.", "ms.", "dr.", "sir", "lord", "lady", "beatles",
)
# Singular words that end in s.
SINGULAR = ("paris", "mars", "jaws", "athens", "brussels", "naples", "algiers", "texas", "arkansas", "kansas")
# Clue values of all board formats.
CLUE_VALUES = (100, 200, 300, 400, 500, 600, 800, 900, 1000, 1200, 1500, 1600, 2000)
# Capitalised words that are no names.
NO_NAMES = (
    "The", "And", "But", "For", "Not", "You", "Your", "Yes", "That", "This", "What", "Who", "Where", "When", "How", "Which", "Here", "There", "Back",
    "Right", "Correct", "Answer", "Daily", "Double", "J!", "Final", "Category", "Categories", "Clue", "Score", "Place", "First", "Second", "Third",
    "Let", "Take", "Look", "Start", "Pick", "Select", "Got", "Put", "Going", "Come", "Most", "Last", "Next", "Okay", "Well", "Now", "Get", "See",
    "Say", "Try", "Make", "Give", "Just", "Also", "Still", "Much", "Many", "Some", "More", "Very", "Than", "Only", "Good", "Great", "Nice",
    "Excellent", "Exactly", "Time", "Round", "Board", "Please", "Today", "Thanks", "Thank", "These", "Those", "They", "Their", "Them", "Because",
    "Would", "Could", "Should", "Been", "Have", "Has", "Had", "Does", "Did",
)
# Fixed pattern: words that make an amount a score or a wager.
SCORE_CONTEXT = r"(?i)(?:wager|wagered|wagers|score|scores|now\s+has|has\s+\$|leads?\s+with|total|behind|ahead|trailing|worth|if\s+you(?:'re|\s+are)\s+(?:right|correct))"
# Fixed pattern: announcements of a selection before the clue.
PREAMBLE = (
    r"(?i)^(?:(?:.*?)\bfor\s+\$?[\d,]+\.?\s+"
    r"|(?:Let'?s\s+(?:stick\s+with|go\s+(?:with|to|back\s+to)|try|do)\s+.*?)\bfor\s+\$?[\d,]+\.?\s+"
    r"|(?:One\s+more\s+time,?\s+we\s+have\s+.*?\.)\s+)"
)


def stripped(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def abbreviated(speaker: Column) -> Column:
    """SPEAKER_00 becomes S00; null becomes UNKNOWN."""
    return F.regexp_replace(F.coalesce(speaker, F.lit("UNKNOWN")), "^SPEAKER_", "S")


def transcript_line(pos: Column, speaker: Column, text: Column) -> Column:
    return F.concat(F.lit("L"), pos.cast("string"), F.lit(" "), abbreviated(speaker), F.lit(": "), stripped(F.coalesce(text, F.lit(""))))


def line_id(c: Column) -> Column:
    """The number of a line id such as L12 or [L12]; null if it is none."""
    return stripped(F.translate(c, "L[]", "")).try_cast("int")


def clamped(i: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(i, n - 1))


def syllables(c: Column) -> Column:
    """Vowel groups of each word, less a silent e, 1 at least for a word and for the text."""
    def of(w):
        n = F.size(F.regexp_extract_all(w, F.lit("[aeiouy]+"), F.lit(0)))
        silent = (n > 1) & w.endswith("e") & ~w.endswith("le")
        return F.greatest(F.lit(1), n - F.when(silent, 1).otherwise(0))

    return F.greatest(F.lit(1), F.aggregate(words(F.lower(c)), F.lit(0), lambda a, w: a + of(w)))


def _amount(text: Column, pattern: str) -> Column:
    return F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "").try_cast("int")


def dollar_value(text: Column) -> Column:
    """The clue value that a selection names: for $n, else the first $n without talk of scores, else for n; null if that is no clue value."""
    ok = lambda v: v.isin(*CLUE_VALUES)
    a, b, c = _amount(text, r"(?i)\bfor\s+\$([\d,]+)"), _amount(text, r"\$([\d,]+)"), _amount(text, r"\bfor\s+(\d{3,4})\b")
    return F.coalesce(F.when(ok(a), a), F.when(ok(b) & ~text.rlike(SCORE_CONTEXT), b), F.when(ok(c), c))


def without_preamble(text: Column, category: Column) -> Column:
    """The clue without the announcement of its selection, if ten characters or more are left."""
    low, cat = stripped(F.lower(text)), stripped(F.lower(category))
    gate = low.startswith(F.substring(cat, 1, 10)) | low.startswith("let's ") | low.startswith("one more time")
    rest = stripped(F.regexp_replace(text, PREAMBLE, ""))
    return F.when(gate & text.rlike(PREAMBLE) & (F.length(rest) >= 10), rest).otherwise(text)


def is_person(c: Column) -> Column:
    w = words(c)
    named = F.size(w).between(2, 4) & F.forall(w, lambda x: x.rlike(r"^\p{Lu}"))
    return F.lower(c).rlike("|".join(x.replace(".", r"\.") for x in PERSON_WORDS)) | named


def is_plural(c: Column) -> Column:
    x = stripped(F.regexp_replace(stripped(c), r"\?+$", ""))
    low = F.lower(x)
    return F.when((x == "") | low.endswith("ss") | low.isin(*SINGULAR), False).when(is_person(x), low.startswith("the ")).otherwise(low.endswith("s"))


def question_form(c: Column) -> Column:
    """A response as a question; blank ones and questions stay as they are."""
    x = stripped(c)
    done = (x == "") | F.lower(x).rlike("^(?:" + "|".join(QUESTION_PREFIXES) + ")")
    who = F.when(is_person(x), "Who").otherwise("What")
    verb = F.when(is_plural(x), " are ").otherwise(" is ")
    return F.when(done, c).otherwise(F.concat(who, verb, x, F.when(x.endswith("?"), "").otherwise("?")))


def wager_amount(c: Column) -> Column:
    """A wager as text: the literal for a True Daily Double, a whole number, else null."""
    x = stripped(c)
    return F.when(x == "True Daily Double", x).otherwise(x.try_cast("int").cast("string"))


def file_size(n: Column) -> Column:
    """Bytes for display."""
    f = lambda d, u: F.concat(F.format_string("%.1f", F.bround(n / d, 1)), F.lit(u))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024**2, f(1024.0, " KB")).when(n < 1024**3, f(1024.0**2, " MB")).otherwise(F.concat(F.format_string("%.2f", F.bround(n / 1024.0**3, 2)), F.lit(" GB")))


def duration(seconds: Column) -> Column:
    """h:mm:ss, or m:ss under an hour."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def masked(secret: Column) -> Column:
    """First and last four signs of a secret of more than eight."""
    return F.when(F.length(secret) > 8, F.concat(F.substring(secret, 1, 4), F.lit("•" * 12), F.substring(secret, -4, 4))).otherwise(F.repeat(F.lit("•"), F.length(secret)))


def episode_id(path: Column) -> Column:
    """A relative path without its extension, / and spaces as _."""
    return F.regexp_replace(F.regexp_replace(path, r"\.[^./]*$", ""), "[/ ]", "_")


def short_id(name: Column) -> Column:
    found = F.regexp_extract(name, r"S\d+E\d+", 0)
    return F.when(found != "", found).otherwise(F.substring(name, 1, 20))


def is_retryable(error: Column) -> Column:
    return error.rlike("429|RESOURCE_EXHAUSTED|500|503|UNAVAILABLE")


def backoff_seconds(attempt: Column, hint: Column | None = None) -> Column:
    """The hinted seconds, else 5 * 2^n, 120 at most."""
    own = F.least(5 * F.pow(F.lit(2.0), attempt), F.lit(120.0))
    return own if hint is None else F.coalesce(hint.cast("double"), own)


def short_error(c: Column) -> Column:
    """An error for display: 40 characters at most."""
    return F.when(F.length(c) > 40, F.concat(F.substring(c, 1, 37), F.lit("..."))).otherwise(c)


def fixed_responses(c: Column) -> Column:
    """How many rows question_form changes: an aggregate."""
    return F.count_if(~question_form(c).eqNullSafe(c))
