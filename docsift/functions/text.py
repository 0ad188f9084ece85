"""Text cleaning as Column expressions.

Word characters are ``[\\p{L}\\p{N}_]`` and blanks are the full Unicode blank
set, written out so that Java regular expressions behave the same for every
script. Combining marks are not word characters.
"""

import functools
import operator
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsift.functions.arrays import bind

BLANK = r"\s\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# ---------------------------------------------------------------------------
# Protected technical terms, in the order they are applied
# (written form, placeholder, display form), default stop words, edge
# punctuation, removal patterns and mask tags.
# ---------------------------------------------------------------------------
TECH_TERMS = [
    ("C++", "__CPP_LANG__", "c++"),
    ("C#", "__CSHARP_LANG__", "c#"),
    ("F#", "__FSHARP_LANG__", "f#"),
    (".NET", "__DOTNET_TECH__", ".net"),
    ("ASP.NET", "__ASPNET_TECH__", "asp.net"),
    ("Node.js", "__NODEJS_TECH__", "node.js"),
    ("Vue.js", "__VUEJS_TECH__", "vue.js"),
    ("React.js", "__REACTJS_TECH__", "react.js"),
    ("Next.js", "__NEXTJS_TECH__", "next.js"),
    ("Nuxt.js", "__NUXTJS_TECH__", "nuxt.js"),
    ("Express.js", "__EXPRESSJS_TECH__", "express.js"),
    ("Three.js", "__THREEJS_TECH__", "three.js"),
    ("D3.js", "__D3JS_TECH__", "d3.js"),
    ("TypeScript", "__TYPESCRIPT_LANG__", "typescript"),
    ("JavaScript", "__JAVASCRIPT_LANG__", "javascript"),
    ("scikit-learn", "__SKLEARN_LIB__", "scikit-learn"),
    ("PyTorch", "__PYTORCH_LIB__", "pytorch"),
    ("TensorFlow", "__TENSORFLOW_LIB__", "tensorflow"),
    ("Keras", "__KERAS_LIB__", "keras"),
    ("OpenCV", "__OPENCV_LIB__", "opencv"),
    ("LangChain", "__LANGCHAIN_LIB__", "langchain"),
    ("CI/CD", "__CICD_DEVOPS__", "ci/cd"),
    ("ETL", "__ETL_TECH__", "etl"),
    ("R", "__R_LANG__", "r"),
]

STOP_WORDS = (
    "i me my we our you your he him his she her it its they them their what which "
    "who this that these those am is are was were be been being have has had do does "
    "did a an the and but if or because as of at by for with about to from in out "
    "on over under then when where how all any not only so than very can will just now"
).split()

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

URL = rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+"
EMAIL = rf"{EDGE}[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}{EDGE}"
EMAIL_MASKED = rf"{EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{EDGE}"
PHONE = (
    rf"(?=[+(\p{{Nd}}]){EDGE}(?:\+?\p{{Nd}}{{1,3}}[{BLANK}.\-]?)?(?:\(?\p{{Nd}}{{2,4}}\)?[{BLANK}.\-]?)?"
    rf"\p{{Nd}}{{3,4}}[{BLANK}.\-]?\p{{Nd}}{{4}}{EDGE}"
)
REPOST = rf"(?:RT|cc)(?![{WORD}])(?<![{WORD}](?:RT|cc))"
MENTION = rf"@[^{BLANK}]+"
HASHTAG = rf"#[^{BLANK}]+"
NOT_WORD = rf"[^{WORD}{BLANK}]"

EMAIL_TAG = "[EMAIL_ANONYMISÉ]"
PHONE_TAG = "[TÉL_ANONYMISÉ]"
# ---------------------------------------------------------------------------

PROTECTED = [display for _, _, display in TECH_TERMS]


def _quoted(term: str) -> str:
    return "".join("\\" + ch if ch in ".+#/-" else ch for ch in term)


def _standing_alone(body: str) -> str:
    return rf"(?iu)(?<![{WORD}])(?:{body})(?![{WORD}])"


def _nfkd_udf():
    # A nested function travels to the workers by value.
    def normalized(texts: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        return pc.utf8_normalize(texts, form="NFKD")

    return F.arrow_udf(normalized, StringType())


def _accents_udf():
    # A batch stays in Arrow; only some of its texts are Python strings at a time.
    def stripped(texts: pa.Array) -> pa.Array:
        import unicodedata

        class Marks(dict):
            """Code points as they are met; combining marks go."""

            def __missing__(self, code: int) -> int | None:
                self[code] = None if unicodedata.combining(chr(code)) else code
                return self[code]

        marks, parts = Marks(), [pa.array([], pa.string())]
        for at in range(0, len(texts), 128):
            some = texts.slice(at, 128).to_pylist()
            parts.append(
                pa.array([t and unicodedata.normalize("NFKD", t).translate(marks) for t in some], pa.string())
            )
        return pa.concat_arrays(parts)

    return F.arrow_udf(stripped, StringType())


def _only_non_ascii(text: Column, apply) -> Column:
    """Send a row through Python only when it holds a non-ASCII character."""
    wide = F.octet_length(text) != F.char_length(text)
    return F.coalesce(apply(F.when(wide, text)), text)


def normalize_nfkd(text: Column) -> Column:
    return _only_non_ascii(text, _nfkd_udf())


def strip_accents(text: Column) -> Column:
    return _only_non_ascii(text, _accents_udf())


def strip_blanks(text: Column) -> Column:
    """Only a text with a blank at an end meets the pattern that looks through all of it."""
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return F.when(ends.rlike(f"[{BLANK}]"), F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+$", "")).otherwise(text)


def _needle(written: str) -> str:
    return written.lower()


def _needles() -> list[str]:
    """Short substrings, one of which occurs in every text with a symbol term."""
    words = {_needle(written) for written, _, _ in TECH_TERMS if len(written) > 1}
    words = {".js" if word.endswith(".js") else word for word in words}
    return sorted(w for w in words if not any(o != w and o in w for o in words))


def _any_of(tests: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def _protect_one(text: Column, folded: Column, written: str, placeholder: str) -> Column:
    pattern = _standing_alone(_quoted(written))
    return bind(
        text,
        lambda t: F.when(
            F.contains(folded, F.lit(_needle(written))),
            F.regexp_replace(t, pattern, f" {placeholder} "),
        ).otherwise(t),
    )


def protect_terms(text: Column) -> Column:
    """Swap technical terms for placeholders, in list order.

    Plain substring tests on the lower-cased text decide which terms are looked
    for, so most texts meet no regular expression here.
    """
    lone = "|".join(
        f"[{c.upper()}{c.lower()}](?![{WORD}])(?<![{WORD}].)"
        for c in (written for written, _, _ in TECH_TERMS if len(written) == 1)
    )

    def swap(t: Column, folded: Column) -> Column:
        for written, placeholder, _ in TECH_TERMS:
            t = _protect_one(t, folded, written, placeholder)
        return t

    def guarded(t: Column, folded: Column) -> Column:
        # A dotless i also stands for i when case is ignored.
        hit = _any_of(F.contains(folded, F.lit(n)) for n in [*_needles(), "\u0131"])
        return F.when(
            hit | t.rlike(lone), bind(F.translate(folded, "\u0131", "i"), lambda f: swap(t, f))
        ).otherwise(t)

    return bind(text, lambda t: bind(F.lower(t), lambda folded: guarded(t, folded)))


def restore_terms(text: Column) -> Column:
    """Turn lower-cased placeholders into their display forms."""

    def swap(t: Column) -> Column:
        for _, placeholder, display in TECH_TERMS:
            t = F.replace(t, F.lit(placeholder.lower()), F.lit(display))
        return t

    return bind(text, lambda t: F.when(F.contains(t, F.lit("__")), swap(t)).otherwise(t))


def remove_urls(text: Column) -> Column:
    return bind(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("://")) | F.contains(t, F.lit("www.")),
            F.regexp_replace(t, URL, " "),
        ).otherwise(t),
    )


def _replace_emails(text: Column, pattern: str, by: str) -> Column:
    return bind(
        text,
        lambda t: F.when(F.contains(t, F.lit("@")), F.regexp_replace(t, pattern, by)).otherwise(t),
    )


def remove_emails(text: Column) -> Column:
    return _replace_emails(text, EMAIL, " ")


def remove_phones(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, " ")


def _replace_from(text: Column, sign: str, pattern: str) -> Column:
    return bind(
        text,
        lambda t: F.when(F.contains(t, F.lit(sign)), F.regexp_replace(t, pattern, " ")).otherwise(t),
    )


def remove_social(text: Column) -> Column:
    text = bind(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("RT")) | F.contains(t, F.lit("cc")), F.regexp_replace(t, REPOST, " ")
        ).otherwise(t),
    )
    return _replace_from(_replace_from(text, "@", MENTION), "#", HASHTAG)


def blank_non_words(text: Column) -> Column:
    return F.regexp_replace(text, NOT_WORD, " ")


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^{BLANK}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def stop_words(language: str | None = None) -> list[str]:
    """The default list, or the list Spark ML ships for ``language`` ('french', ...)."""
    if language is None:
        return list(STOP_WORDS)
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords(language)


def trim_tokens(tokens: Column) -> Column:
    """Strip edge punctuation and underscores; protected terms stay as they are."""
    return F.transform(
        tokens,
        lambda t: F.when(t.isin(PROTECTED), t).otherwise(F.btrim(t, F.lit(PUNCTUATION))),
    )


def _long_enough(token: Column, keep_protected: bool) -> Column:
    enough = F.length(token) >= 2
    return enough | token.isin(PROTECTED) if keep_protected else enough


def _listed(words: Iterable[str]) -> list[str]:
    """The one-letter language names r and c never count as stop words."""
    return sorted(set(words) - {"r", "c"})


def drop_short(tokens: Column, keep_protected: bool = False) -> Column:
    return F.filter(tokens, lambda t: _long_enough(t, keep_protected))


def drop_stop_words(tokens: Column, words: Iterable[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(_listed(words)))


def _protect_where_needed(text: Column) -> Column:
    """``protect_terms`` for texts in which it can change the tokens.

    A term of letters alone reads the same without protection unless a link, an
    address or a tag might swallow it. So only texts with a symbol term, one of
    those signs, or a dotless i go through the replacement.
    """
    symbol_terms = sorted({_needle(w) for w, _, _ in TECH_TERMS if not w.isalpha()})
    symbol_terms = {".js" if w.endswith(".js") else "#" if w.endswith("#") else w for w in symbol_terms}
    folded_needles = sorted(w for w in symbol_terms if not any(o != w and o in w for o in symbol_terms))

    def needed(t: Column, folded: Column) -> Column:
        signs = _any_of(F.contains(t, F.lit(sign)) for sign in ("@", "://", "www.", "\u0131"))
        return signs | _any_of(F.contains(folded, F.lit(n)) for n in folded_needles)

    return bind(
        text, lambda t: F.when(bind(F.lower(t), lambda f: needed(t, f)), protect_terms(t)).otherwise(t)
    )


def prepared_text(text: Column) -> Column:
    """Everything that happens to the text before its words are taken out."""
    text = _protect_where_needed(normalize_nfkd(F.coalesce(text, F.lit(""))))
    return remove_social(remove_phones(remove_emails(remove_urls(text))))


def clean_tokens(
    text: Column,
    words: Iterable[str] | None = STOP_WORDS,
    keep_protected_short: bool = False,
) -> Column:
    """Tokens of the cleaned text; ``words=None`` keeps stop words.

    Runs of word characters are taken out and lower-cased. Placeholders and edge
    punctuation can occur only in texts with an underscore.
    """

    def kept(token: Column) -> Column:
        keep = _long_enough(token, keep_protected_short)
        return keep if words is None else keep & ~token.isin(_listed(words))

    def tokens(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(rf"[{WORD}]+"), F.lit(0))
        plain = F.transform(found, F.lower)
        restored = trim_tokens(F.transform(found, lambda k: restore_terms(F.lower(k))))
        return F.filter(F.when(F.contains(t, F.lit("_")), restored).otherwise(plain), kept)

    return bind(prepared_text(text), tokens)


def clean_text(text: Column, **options) -> Column:
    return F.array_join(clean_tokens(text, **options), " ")


def vector_tokens(text: Column, pattern: str = "word2", accents: bool = True) -> Column:
    """Tokens for the vectoriser.

    ``word2`` takes runs of two or more word characters (so ``c++`` is lost and
    ``node.js`` gives two terms); ``blank`` splits at blanks and keeps them.
    ``accents=False`` skips accent stripping for text that is already clean.
    """
    text = F.lower(F.coalesce(text, F.lit("")))
    if accents:
        text = strip_accents(text)
    if pattern == "blank":
        return split_words(text)
    if pattern != "word2":
        raise ValueError(f"unknown token pattern {pattern!r}")
    return F.regexp_extract_all(text, F.lit(rf"[{WORD}]{{2,}}"), F.lit(0))


def vector_words(text: Column, accents: bool = True) -> Column:
    """``vector_tokens`` joined by blanks."""
    return F.array_join(vector_tokens(text, accents=accents), " ")


def mask_pii(text: Column) -> Column:
    return F.regexp_replace(_replace_emails(text, EMAIL_MASKED, EMAIL_TAG), PHONE, PHONE_TAG)


def duplicate_key(text: Column) -> Column:
    """Lower case without punctuation: equal keys mean near-duplicates."""
    return F.regexp_replace(F.lower(text), NOT_WORD, "")


def fingerprint(text: Column) -> Column:
    """128-bit key that stands for the text in shuffles."""
    return F.md5(text)


def model_token_count(text: Column) -> Column:
    """Lower bound for a sub-word tokenizer: words + punctuation marks + 2 specials."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[{WORD}]+|{NOT_WORD}"), F.lit(0))
    return F.size(pieces) + F.lit(2)


def preview(text: Column, length: int, dots: bool = True) -> Column:
    cut = F.substring(text, 1, length)
    return F.when(F.length(text) > length, F.concat(cut, F.lit("..."))).otherwise(text) if dots else cut


def percent_text(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def slug(name: Column) -> Column:
    """File-name form of a model name: blanks, - and + become _, brackets go."""
    return F.translate(F.lower(name), " -+()", "___")
