"""Time patterns, bounds and intervals."""

from __future__ import annotations

import datetime as dt
import re

from ..functions.convert import instant

_LETTERS = {"yyyy": "%Y", "uuuu": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}
_ZONES = {"X": "Z", "XX": "Z", "XXX": "Z", "Z": "+0000"}
_STEPS = {"%S": 1, "%M": 60, "%H": 3600, "%d": 86400, "%m": 86400, "%Y": 86400}


class TimeFormat:
    """A date pattern of y M d H m s S, quoted text and zones; times are in UTC. step: the seconds it can tell apart."""

    TOKEN = re.compile(r"'((?:[^']|'')*)'|(([a-zA-Z])\3*)|([^a-zA-Z'])")

    def __init__(self, pattern: str):
        self.parts: list[tuple[str, str]] = []
        self.step = 86400.0
        at = 0
        while at < len(pattern):
            m = self.TOKEN.match(pattern, at)
            if m is None:
                raise ValueError("a quote isn't closed")
            at = m.end()
            quoted, letters, _, other = m.groups()
            if letters is None:
                self.parts.append(("text", other or (quoted or "'").replace("''", "'")))
            elif letters in _LETTERS:
                self.parts.append(("time", _LETTERS[letters]))
                self.step = min(self.step, _STEPS[_LETTERS[letters]])
            elif set(letters) == {"S"}:
                self.parts.append(("fraction", letters))
                self.step = min(self.step, 10.0 ** -min(len(letters), 6))
            elif letters in _ZONES:
                self.parts.append(("text", _ZONES[letters]))
            else:
                raise ValueError(f"the pattern letters {letters!r} aren't known")

    def format(self, at: dt.datetime) -> str:
        at = at.astimezone(dt.timezone.utc)
        out = []
        for kind, part in self.parts:
            if kind == "time":
                out.append(at.strftime(part).zfill(4) if part == "%Y" else at.strftime(part))
            else:
                out.append(part if kind == "text" else f"{at.microsecond:06d}".ljust(len(part), "0")[: len(part)])
        return "".join(out)


def bound(text: str) -> dt.datetime | None:
    """An instant, else a local time as UTC, else a date at midnight UTC."""
    text = text.strip()
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        text += "T00:00:00Z"
    return instant(text)


def iso(at: dt.datetime) -> str:
    """ISO text of an instant, with a fraction only if there is one."""
    at = at.astimezone(dt.timezone.utc)
    fraction = f".{at.microsecond:06d}".rstrip("0").rstrip(".") if at.microsecond else ""
    if fraction and len(fraction) <= 4:
        fraction = fraction.ljust(4, "0")
    return at.strftime("%Y-%m-%dT%H:%M:%S") + fraction + "Z"
