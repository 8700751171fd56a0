"""Hangul arithmetic: jamo, QWERTY keystrokes (two-set layout) and back, romanisation.

Plain Python; used inside Arrow and pandas functions. The Column versions are
in ``names``.
"""

from __future__ import annotations

import re

# Jamo in code point order and their keystrokes on the two-set keyboard.
INITIALS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
VOWELS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
FINALS = ["", *"ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"]
INITIAL_KEYS = "r R s e E f a q Q t T d w W c z x v g".split()
VOWEL_KEYS = "k o i O j p u P h hk ho hl y n nj np nl b m ml l".split()
FINAL_KEYS = ["", *"r R rt s sw sg e f fr fa fq ft fx fv fg a q qt t T d w c z x v g".split()]
# Revised romanisation, without assimilation.
INITIAL_LATIN = "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" ")
VOWEL_LATIN = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split()
FINAL_LATIN = ["", *"k k k n n n t l k m l l l p l m p p t t ng t t k t p h".split()]

BASE, LAST = 0xAC00, 0xD7A3
_VOWEL = "|".join(sorted(VOWEL_KEYS, key=lambda k: -len(k)))
_FINAL = "|".join(sorted(filter(None, FINAL_KEYS), key=lambda k: -len(k)))
_SYLLABLE = re.compile(f"([{''.join(INITIAL_KEYS)}])({_VOWEL})((?:{_FINAL})(?![{''.join(set(''.join(VOWEL_KEYS)))}]))?")
_I, _V, _F = ({k: i for i, k in enumerate(keys)} for keys in (INITIAL_KEYS, VOWEL_KEYS, FINAL_KEYS))


def split(ch: str) -> tuple[int, int, int] | None:
    """Indices of initial, vowel and final of a syllable; None for other characters."""
    c = ord(ch) - BASE
    return (c // 588, c % 588 // 28, c % 28) if 0 <= c <= LAST - BASE else None


def compose(initial: int, vowel: int, final: int = 0) -> str:
    return chr(BASE + (initial * 21 + vowel) * 28 + final)


def to_keys(text: str) -> str:
    """Keystrokes that type ``text``; other characters stay."""
    single = {j: k for js, ks in ((INITIALS, INITIAL_KEYS), (VOWELS, VOWEL_KEYS), (FINALS, FINAL_KEYS)) for j, k in zip(js, ks) if j}
    return "".join(INITIAL_KEYS[s[0]] + VOWEL_KEYS[s[1]] + FINAL_KEYS[s[2]] if (s := split(ch)) else single.get(ch, ch) for ch in text)


def from_keys(text: str) -> str:
    """Hangul typed on a Latin layout back to syllables; what forms no syllable stays."""
    return _SYLLABLE.sub(lambda m: compose(_I[m[1]], _V[m[2]], _F[m[3] or ""]), text)


def to_latin(text: str) -> str:
    """Syllable by syllable romanisation; other characters stay."""
    return "".join(INITIAL_LATIN[s[0]] + VOWEL_LATIN[s[1]] + FINAL_LATIN[s[2]] if (s := split(ch)) else ch for ch in text)


def jamo(text: str) -> str:
    """Compatibility jamo of all syllables."""
    return "".join(INITIALS[s[0]] + VOWELS[s[1]] + FINALS[s[2]] if (s := split(ch)) else ch for ch in text)
