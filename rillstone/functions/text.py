"""Tokenisers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words.
ENGLISH_STOP_WORDS = """
a about above after again against ain all am an and any are aren aren't as at be because been
before being below between both but by can couldn couldn't d did didn didn't do does doesn doesn't
doing don don't down during each few for from further had hadn hadn't has hasn hasn't have haven
haven't having he he'd he'll he's her here hers herself him himself his how i i'd i'll i'm i've if
in into is isn isn't it it'd it'll it's its itself just ll m ma me mightn mightn't more most mustn
mustn't my myself needn needn't no nor not now o of off on once only or other our ours ourselves
out over own re s same shan shan't she she'd she'll she's should should've shouldn shouldn't so
some such t than that that'll the their theirs them themselves then there these they they'd they'll
they're they've this those through to too under until up ve very was wasn wasn't we we'd we'll
we're we've were weren weren't what when where which while who whom why will with won won't wouldn
wouldn't y you you'd you'll you're you've your yours yourself yourselves
""".split()

# The 32 ASCII punctuation characters.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Token patterns, with word characters spelled out: letters and digits of any script.
WORDS_OF_TWO = r"[\p{L}\p{N}_]{2,}"
WORDS_WITH_APOSTROPHE = r"[\p{L}\p{N}_']+[\p{L}\p{N}_]"


def tokens(c: Column | str, pattern: str = WORDS_OF_TWO) -> Column:
    """Lower-case tokens matching ``pattern``, in text order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))


def plain_words(c: Column | str, stop_words: list[str] = ENGLISH_STOP_WORDS) -> Column:
    """Words left after removing ASCII punctuation and stop words; case is kept."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.translate(c, ASCII_PUNCTUATION, "")
    words = F.split(bare, r"[\s\p{Z}]+")
    return F.filter(words, lambda w: (w != "") & ~F.lower(w).isin(stop_words))


def with_bigrams(words: Column) -> Column:
    """The words followed by each pair of neighbours joined by a space."""

    def both(w: Column) -> Column:
        # slice() is given a length that cannot be negative, so short texts give no pair
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(w, pairs)

    # bound as a lambda variable, so the words are extracted once and not once per use
    return F.get(F.transform(F.array(words), both), F.lit(0))
