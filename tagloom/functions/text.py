"""Column expressions for cleaning, splitting and combining article text."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as cfg

# Unicode white space, which Java's \s alone does not cover.
SPACE = r"\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
URLS = rf"http[^{SPACE}]+|www\.[^{SPACE}]+"
TAGS = r"<[^>]+>"
NOT_LETTERS = r"[^a-z\s]"
CONTRACTIONS = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def blank(c: str | Column) -> Column:
    """Null text counts as empty text."""
    return F.coalesce(col(c), F.lit(""))


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def words(c: str | Column) -> Column:
    """White-space separated words; the empty pieces at either end are dropped."""
    return F.filter(F.split(blank(c), rf"[{SPACE}]+"), lambda w: w != "")


def word_count(c: str | Column) -> Column:
    return F.size(words(c))


@lru_cache(maxsize=None)
def default_stop_words() -> tuple[str, ...]:
    """Spark's English list, the pieces of its apostrophe words, and the corpus list."""
    base = cfg.ENGLISH_STOP_WORDS
    pieces = [p for w in base if "'" in w for p in w.split("'") if p]
    return tuple(sorted({w for w in base if "'" not in w} | set(pieces) | set(cfg.CUSTOM_STOP_WORDS)))


def letters_only(c: str | Column) -> Column:
    """Lower case, then URLs, tags and everything but letters removed, in that order."""
    t = F.lower(blank(c))
    t = F.regexp_replace(t, URLS, "")
    t = F.regexp_replace(t, TAGS, "")
    t = F.regexp_replace(t, NOT_LETTERS, " ")
    return F.regexp_replace(t, CONTRACTIONS, "$1$3$5$7 $2$4$6$8")


def raw_tokens(c: str | Column) -> Column:
    return F.split(letters_only(c), r"\s+")


def is_content_word(t: Column, stop_words=None) -> Column:
    stops = default_stop_words() if stop_words is None else stop_words
    keep = F.length(t) > 2
    return keep & ~t.isin(*stops) if len(stops) else keep


def clean_tokens(c: str | Column, stop_words=None) -> Column:
    """Content words of a text, not yet lemmatised."""
    return F.filter(raw_tokens(c), lambda t: is_content_word(t, stop_words))


def clean_alnum(c: str | Column) -> Column:
    t = F.regexp_replace(F.lower(blank(c)), r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def combined_text(title="Title", text="text") -> Column:
    return F.concat(blank(title), F.lit(". "), blank(text))


def combined_short(title="Title", text="text", max_chars: int = cfg.MAX_CHARS) -> Column:
    return F.concat(blank(title), F.lit(". "), F.substring(blank(text), 1, max_chars))


def clean_combined(title_tokens: Column, body_tokens: Column, title_weight: int = cfg.TITLE_WEIGHT) -> Column:
    """Cleaned title repeated, then the cleaned body; an empty part still leaves its space."""
    title = F.array_join(title_tokens, " ")
    parts = F.concat(F.array_repeat(title, title_weight), F.array(F.array_join(body_tokens, " ")))
    return F.array_join(parts, " ")


def raw_combined(title="Title", text="text", max_words: int = cfg.RAW_BODY_WORDS) -> Column:
    body = F.array_join(F.slice(words(text), 1, max_words), " ")
    return F.concat(trim_space(blank(title)), F.lit(" [SEP] "), body)


def section_title_text(section="Section", title="Title", text="text",
                       max_chars: int = cfg.SECTION_TITLE_MAX_CHARS) -> Column:
    return F.left(F.concat_ws(" | ", blank(section), blank(title), blank(text)), F.lit(max_chars))


def embedding_prompt(text="text", title=None, task: str = "classification") -> Column:
    if task not in cfg.PROMPT_TASKS:
        raise ValueError(f"task must be one of {cfg.PROMPT_TASKS}, got {task!r}")
    shown = F.lit("") if title is None else blank(title)
    return F.format_string(f'title: {{title | "%s"}} | task: {task} | text: {{%s}}', shown, blank(text))


def extract_user_need(tags="Tags") -> Column:
    """Label of the first trimmed tag that starts with the label prefix, else unlabeled."""
    trimmed = F.transform(F.split(blank(tags), ","), trim_space)
    hits = F.filter(trimmed, lambda t: t.startswith(cfg.LABEL_TAG_PREFIX))
    label = F.transform(hits, lambda t: F.substr(t, F.lit(len(cfg.LABEL_TAG_PREFIX) + 1)))
    return F.coalesce(F.get(label, F.lit(0)), F.lit(cfg.UNLABELED))


def ngrams(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """All n-grams of a token array for n from lo to hi."""

    def of_size(n: int) -> Column:
        if n == 1:
            return tokens
        shifted = [F.slice(tokens, F.lit(i + 1), F.greatest(F.size(tokens) - n + 1, F.lit(0))) for i in range(n)]
        return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, F.lit(" "), y)), shifted)

    parts = [of_size(n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)
