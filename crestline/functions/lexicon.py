"""Hype signal of a text: exclamation marks, shouted words, hype phrases, emoji."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The phrase list and emoji set that define the signal.
HYPE_PHRASES = (
    "cant wait", "can't wait", "cannot wait", "hype", "hyped", "insane", "peak", "goosebump",
    "masterpiece", "cinema", "goat", "fire", "banger", "chills", "epic", "amazing", "incredible",
    "perfect", "legend", "crazy", "best", "love", "excited", "finally", "need this", "day one",
)
HYPE_EMOJI = "🔥😍🤩😭❤️🥹🙌💯👏😱⚡🎬"  # counted per code point, so ❤️ counts twice

_WORD = r"[\p{L}\p{N}_]"
# a match begins with a cheap look at one character; the costly look behind it comes second
_FIRST = "".join(sorted({x for p in HYPE_PHRASES for x in (p[0], p[0].upper())}))
_PHRASE = f"(?i)(?=[{_FIRST}])(?<!{_WORD})(?:{'|'.join(HYPE_PHRASES)})(?!{_WORD})"
_SHOUTED = f"[A-Z](?<!{_WORD}[A-Z])[A-Z]{{2,}}(?!{_WORD})"


def _removed(text: Column, chars: str) -> Column:
    """How many code points of ``chars`` a text holds."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def hype_points(text: Column) -> Column:
    """Points of one text; a null text scores 0."""
    t = F.coalesce(text, F.lit(""))
    plain = F.length(t) == F.octet_length(t)
    emoji = F.when(plain, F.lit(0)).otherwise(_removed(t, HYPE_EMOJI))
    bangs = F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))
    shouted, phrases = (F.regexp_count(t, F.lit(p)) for p in (_SHOUTED, _PHRASE))
    return (bangs + shouted + 2 * phrases + emoji).cast("double")
