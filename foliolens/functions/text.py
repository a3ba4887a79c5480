"""Row-local text expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space that splitting and trimming recognise.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = "\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

TOKEN_PATTERN = "([\\p{L}\\p{N}_]{2,})"
WORD_PATTERN = "([\\p{L}\\p{N}]+)"
SENTENCE_PATTERN = "([^.!?]+[.!?]*)"

# Word classes counted per line, the Penn tags of each, and closed-class words.
TAG_CLASSES = {
    "num_verbs": ["VB", "VBD", "VBG", "VBN", "VBP", "VBZ"],
    "num_nouns": ["NN", "NNS", "NNP", "NNPS"],
    "num_adjectives": ["JJ", "JJR", "JJS"],
    "num_adverbs": ["RB", "RBR", "RBS"],
    "num_pronouns": ["PRP", "PRP$", "WP", "WP$"],
    "num_cardinals": ["CD"],
    "num_conjunctions": ["CC"],
    "num_predeterminers": ["PDT"],
    "num_interjections": ["UH"],
}
LEXICON = {
    "PRP": ["i", "you", "he", "she", "it", "we", "they", "me", "him", "us", "them", "myself", "yourself",
            "himself", "herself", "itself", "ourselves", "themselves"],
    "PRP$": ["my", "your", "his", "her", "its", "our", "their"],
    "WP": ["who", "whom", "what"],
    "WP$": ["whose"],
    "CC": ["and", "or", "but", "nor", "yet"],
    "PDT": ["all", "both", "half", "such"],
    "UH": ["oh", "wow", "hey", "hello", "yes", "please"],
    "DT": ["the", "a", "an", "this", "that", "these", "those", "no", "every", "each", "some", "any"],
    "IN": ["of", "in", "on", "at", "by", "for", "with", "from", "as", "if", "into", "than", "about", "after",
           "before", "under", "over", "between", "through", "during", "without", "within"],
    "TO": ["to"],
    "MD": ["can", "could", "may", "might", "must", "shall", "should", "will", "would"],
    "WRB": ["how", "when", "where", "why"],
    "WDT": ["which"],
    "EX": ["there"],
    "CD": ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"],
    "VB": ["be", "do", "have", "make", "get", "go"],
    "VBZ": ["is", "has", "does"],
    "VBP": ["are", "am"],
    "VBD": ["was", "were", "had", "did"],
    "VBN": ["been", "done"],
    "RB": ["not", "very", "also", "too", "here", "now", "then", "never", "always", "only"],
    "JJ": ["good", "new", "great", "other", "many", "large", "small", "high", "low", "first", "last"],
    "JJR": ["better", "more", "less"],
    "JJS": ["best", "most", "least"],
}
# Endings that decide the tag of a word outside the lexicon, first match wins.
SUFFIXES = [("ly", "RB"), ("ing", "VBG"), ("ed", "VBD"), ("ous", "JJ"), ("ful", "JJ"), ("able", "JJ"),
            ("ible", "JJ"), ("al", "JJ"), ("est", "JJS"), ("s", "NNS")]


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(WHITESPACE))


def collapse(text: Column | str) -> Column:
    """Runs of two or more white space characters become one space; the ends are trimmed."""
    return strip(F.regexp_replace(_col(text), f"[{SPACE_CLASS}]{{2,}}", " "))


def squeeze(text: Column | str) -> Column:
    """Every run of white space becomes one space; the ends are trimmed."""
    return strip(F.regexp_replace(_col(text), f"[{SPACE_CLASS}]+", " "))


def word_count(text: Column | str) -> Column:
    return words_of_collapsed(squeeze(text))


def words_of_collapsed(text: Column | str) -> Column:
    """Word count of text that `collapse` returned: single white space characters stand between words alone."""
    text = _col(text)
    gaps = F.char_length(text) - F.char_length(F.translate(text, WHITESPACE, ""))
    return F.when(text == "", 0).otherwise(gaps + 1).cast("int")


def has_alnum(text: Column | str, at_least: int) -> Column:
    """At least so many letters or digits of any script; reads no further than to the last one needed."""
    return _col(text).rlike(f"(?:[\\p{{L}}\\p{{N}}][^\\p{{L}}\\p{{N}}]*+){{{at_least}}}")


def has_ascii_alnum(text: Column | str) -> Column:
    return _col(text).rlike("[A-Za-z0-9]")


def is_upper(text: Column | str) -> Column:
    text = _col(text)
    cased = text.rlike("\\p{IsUppercase}")
    return (cased & ~text.rlike("[\\p{IsLowercase}\\p{Lt}]")).cast("int")


def is_numbered(text: Column | str) -> Column:
    return _col(text).rlike("^\\p{Nd}+(\\.\\p{Nd}+)*").cast("int")


def ends_with_colon(text: Column | str) -> Column:
    return _col(text).endswith(":").cast("int")


def bold_from_flags(flags: Column | str, mask: int = 2) -> Column:
    return (_col(flags).bitwiseAND(F.lit(mask)) > 0).cast("int")


def bold_from_font(font: Column | str) -> Column:
    return F.lower(_col(font)).rlike("bold|black").cast("int")


def clean_title(text: Column | str, limit: int = 100) -> Column:
    """White space squeezed; a long text is cut after its first full stop, else at `limit` with an ellipsis."""
    title = squeeze(text)
    stop = F.instr(title, ".")
    cut = F.concat(F.rtrim(F.substring(title, 1, limit), F.lit(WHITESPACE)), F.lit("..."))
    by_sentence = F.when(stop.between(2, limit), F.substring(title, F.lit(1), stop)).otherwise(cut)
    return F.when(F.char_length(title) > limit, by_sentence).otherwise(title)


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), F.lit(1))


def sentences(text: Column | str) -> Column:
    found = F.regexp_extract_all(_col(text), F.lit(SENTENCE_PATTERN), F.lit(1))
    return F.filter(F.transform(found, strip), lambda s: s != "")


def word_tag(word: Column, lexicon: dict[str, list[str]] | None = None) -> Column:
    """Tag of one lower-cased word: digits, then the lexicon, then endings, else a noun."""
    tag = F.when(word.rlike("^[0-9]+$"), F.lit("CD"))
    for name, words in (lexicon or LEXICON).items():
        tag = tag.when(word.isin(words), F.lit(name))
    for ending, name in SUFFIXES:
        tag = tag.when(word.endswith(ending), F.lit(name))
    return tag.otherwise(F.lit("NN"))


def word_tags(text: Column | str, lexicon: dict[str, list[str]] | None = None) -> Column:
    words = F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_PATTERN), F.lit(1))
    return F.transform(words, lambda w: word_tag(w, lexicon))


def tag_counts(tags: Column | str) -> list[Column]:
    """The nine word-class counts of an array of tags."""
    return [_count_of(_col(tags), names).alias(column) for column, names in TAG_CLASSES.items()]


def _count_of(tags: Column, names: list[str]) -> Column:
    return F.size(F.filter(tags, lambda tag: tag.isin(names)))


#: A character for each counted class, and one for all other words.
CLASS_MARKS, NO_CLASS = dict(zip(TAG_CLASSES, "abcdefghi")), "-"


def _word_mark(word: Column, lexicon: dict[str, list[str]]) -> Column:
    """The mark of one lower-cased word's class: that of `word_tag`, with few tests for most words."""
    of_tag = {tag: CLASS_MARKS[column] for column, tags in TAG_CLASSES.items() for tag in tags}
    of_word: dict[str, str] = {}
    for tag, words in lexicon.items():
        for w in words:
            of_word.setdefault(w, of_tag.get(tag, NO_CLASS))
    listed = F.lit(NO_CLASS)
    for mark in dict.fromkeys(of_word.values()):
        if mark != NO_CLASS:
            listed = F.when(word.isin([w for w, m in of_word.items() if m == mark]), F.lit(mark)).otherwise(listed)
    ending = F.lit(of_tag["NN"])
    for end, tag in reversed(SUFFIXES):
        ending = F.when(word.endswith(end), F.lit(of_tag.get(tag, NO_CLASS))).otherwise(ending)
    rest = F.when(word.isin([w for w, m in of_word.items() if m == NO_CLASS]), F.lit(NO_CLASS))
    rest = rest.when(word.isin(list(of_word)), listed).otherwise(ending)
    # Whatever begins with a digit sorts before the colon.
    return F.when((word < ":") & word.rlike("^[0-9]+$"), F.lit(of_tag["CD"])).otherwise(rest)


def word_marks(text: Column | str, lexicon: dict[str, list[str]] | None = None) -> Column:
    """The marks of the words of `word_tags`, in one string."""
    words = F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_PATTERN), F.lit(1))
    return F.array_join(F.transform(words, lambda w: _word_mark(w, LEXICON if lexicon is None else lexicon)), "")


def mark_counts(marks: Column | str) -> list[Column]:
    """The nine word-class counts of a string of marks, those of `tag_counts`."""
    marks = _col(marks)
    others = {name: F.octet_length(F.replace(marks, F.lit(mark), F.lit(""))) for name, mark in CLASS_MARKS.items()}
    return [(F.octet_length(marks) - rest).alias(name) for name, rest in others.items()]
