"""Repair and normal forms of Thai text, as column expressions.

All but NFC are built-in functions; NFC has no built-in and is one Arrow UDF, which ``normalize`` calls only for rows that
are not already plain (see ``needs_nfc``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .matching import strip

# Code points and words that decide results.
THAI_DIGITS, ARABIC_DIGITS = "๐๑๒๓๔๕๖๗๘๙", "0123456789"
INVISIBLE = "​‌‍‎‏﻿­"
PRIVATE_MARKS = {
    "": "ิ", "": "ี", "": "ื", "": "่", "": "้", "": "่", "": "้",
    "": "๊", "": "๋", "": "์", "": "ญ", "": "ั", "": "็", "": "่",
}
COMBINING = r"ัิ-ฺ็-๎"
SPACES = r"[ \t  - ]+"
STRUCTURAL_STARTS = ["มาตรา", "ข้อ", "หมวด", "ส่วน", "วรรค", "อนุมาตรา", "ภาค", "ลักษณะ", "บทเฉพาะกาล", "บทกำหนดโทษ", "บททั่วไป", "ผู้รับสนอง", "ประกาศ", "ให้ไว้", "ราชกิจจานุเบกษา", "เล่ม", "หมายเหตุ", "อาศัยอำนาจ"]
SPACED_STARTS = [r"พ\.ศ\.", r"\(ฉบับที่", r"ลงวันที่", r"ครั้งที่"]
SWAPPED_MARKERS = ["มำตรำ", "พระรำชบัญญัติ", "ตำมควำม", "อ้ำเภอ", "รำชกำร"]
REAL_TONE_AM = "นซคลชยจ"
TONE_THEN_AA = "ทหขบผฝส"
TONES = "่้๊๋็์"
LEADING_VOWELS = "เแโใไ"
TRUE_AM = ""


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


def restore_private_marks(c: Column) -> Column:
    """Private-use marks of some fonts as the Thai ones; unknown ones stay."""
    return F.translate(c, "".join(PRIVATE_MARKS), "".join(PRIVATE_MARKS.values()))


def unknown_private_marks(c: Column) -> Column:
    return F.regexp_count(restore_private_marks(c), F.lit(r"[-]")).cast("long")


def arabic_digits(c: Column) -> Column:
    return F.translate(c, THAI_DIGITS, ARABIC_DIGITS)


def thai_digits(c: Column) -> Column:
    return F.translate(c, ARABIC_DIGITS, THAI_DIGITS)


def compose_sara_am(c: Column) -> Column:
    return F.replace(c, F.lit("ํา"), F.lit("ำ"))


def restore_sara_am(c: Column) -> Column:
    """A sara am whose upper part became a space."""
    return F.regexp_replace(c, rf"([ก-ฮ][{COMBINING}]?) [าำ]", "$1ำ")


def needs_nfc(c: Column) -> Column:
    """Whether NFC could change the text: it holds a character beyond Latin-1, Thai, plain punctuation and private use, or Thai marks out of their
    canonical order (a vowel below after a tone, a dot below after either)."""
    return c.rlike("[^\\x00-\\xff\\u0e00-\\u0e7f\\u200b-\\u200f\\u2010-\\u2027\\ue000-\\uf8ff\\ufeff]|[\\u0e48-\\u0e4b][\\u0e38-\\u0e3a]|[\\u0e38\\u0e39]\\u0e3a")


def nfc(c: Column) -> Column:
    """NFC; only texts that it could change are sent to Python."""
    return F.coalesce(_nfc(F.when(needs_nfc(c), c)), c)


def normalize_unicode(c: Column) -> Column:
    return compose_sara_am(nfc(c))


def strip_invisible(c: Column) -> Column:
    return F.translate(c, INVISIBLE, "")


def collapse_whitespace(c: Column, preserve_newlines: bool = True) -> Column:
    c = F.regexp_replace(c, SPACES, " ")
    if preserve_newlines:
        c = F.regexp_replace(c, r"\n{3,}", "\n\n")
        c = F.regexp_replace(c, r"(?U)[\s\x1c-\x1f&&[^\n]]*\n[\s\x1c-\x1f&&[^\n]]*", "\n")
    else:
        c = F.regexp_replace(F.replace(c, F.lit("\n"), F.lit(" ")), SPACES, " ")
    return strip(c)


def has_swapped_sara_aa(c: Column) -> Column:
    out = F.lit(False)
    for word in SWAPPED_MARKERS:
        out = out | F.contains(c, F.lit(word))
    return out


def repair_swapped_sara_aa(c: Column, force: bool = False) -> Column:
    """Undo a font that prints sara aa as sara am, and sara am with a tone mark before it."""
    kept = F.regexp_replace(c, f"([{REAL_TONE_AM}])้ำ", f"$1้{TRUE_AM}")
    kept = F.regexp_replace(kept, f"(?![{TONE_THEN_AA}]้ำ)([ก-ฮ])้ำ", f"$1{TRUE_AM}")
    fixed = F.translate(kept, "ำ" + TRUE_AM, "าำ")
    return fixed if force else F.when(has_swapped_sara_aa(c), fixed).otherwise(c)


def join_broken_words(c: Column) -> Column:
    """Words that a line break cuts, but for paragraphs, structural starts and elements that a space precedes."""
    c = F.regexp_replace(c, rf"([฀-๿])\n(?!\n)[ \t]*({'|'.join(SPACED_STARTS)})", "$1 $2")
    return F.regexp_replace(c, rf"([฀-๿])\n(?!\n)[ \t]*(?!{'|'.join(STRUCTURAL_STARTS)})([฀-๿])", "$1$2")


def drop_orphan_marks(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?md)^[{COMBINING}]+", "")


def reattach_marks(c: Column) -> Column:
    """A tone mark at a line's end moves into the short word that begins the next line, after its initial consonant."""
    word = rf"(?=[ก-ฮ{LEADING_VOWELS}][ก-ฮะ-ู]{{1,3}}(?![ก-๙]))"
    return F.regexp_replace(c, rf"([{TONES}])\n[ \t]*{word}([{LEADING_VOWELS}]?[หอ][ก-ฮ]|[{LEADING_VOWELS}][ก-ฮะ-ู]|[ก-ฮ])", "\n$2$1")


def tight_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+([,.;:!?)\]}])", "$1")


def normalize(c: Column, join_words: bool = True, convert_digits: bool = True) -> Column:
    """The whole repair, in the order in which each step finds what it reads."""
    c = restore_private_marks(c)
    c = restore_sara_am(strip_invisible(normalize_unicode(c)))
    c = drop_orphan_marks(reattach_marks(c))
    if convert_digits:
        c = arabic_digits(c)
    if join_words:
        c = join_broken_words(c)
    return tight_punctuation(collapse_whitespace(c))


def match_key(c: Column) -> Column:
    """A key for duplicates: normal form without case, space and punctuation."""
    c = F.lower(normalize(c, join_words=False))
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[\s๏๚๛]+", ""), r"(?U)[^\p{L}\p{N}_฀-๿]", "")


def thai_ratio(c: Column) -> Column:
    """Thai share of the characters that are no white space; 0 if there are none."""
    rest = F.length(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]", ""))
    thai = rest - F.length(F.regexp_replace(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]", ""), r"[฀-๿]", ""))
    return F.coalesce(F.try_divide(thai.cast("double"), rest), F.lit(0.0))
