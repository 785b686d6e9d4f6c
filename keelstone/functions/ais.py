"""AIS: NMEA checksums as a Column, and position and static reports from six-bit payloads (ITU-R M.1371)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .udf import vectorised

SENTENCE = r"\A[!$](AI|BS)VD[MO],[1-9],[1-9],[0-9]?,[AB]?,[0-W`-w]*,[0-5]\*[0-9A-Fa-f]{2}\z"


def checksum_valid(sentence: Column) -> Column:
    """The exclusive or of the characters between the first and the star is the number after it."""
    body = F.regexp_extract(sentence, r"\A[!$]([^*]*)\*([0-9A-Fa-f]{2})\z", 1)
    stated = F.regexp_extract(sentence, r"\A[!$]([^*]*)\*([0-9A-Fa-f]{2})\z", 2)
    codes = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), F.ascii)
    return F.coalesce((stated != "") & (F.lpad(F.hex(F.aggregate(codes, F.lit(0), lambda a, c: a.bitwiseXOR(c))), 2, "0") == F.upper(stated)), F.lit(False))


def sentence_valid(sentence: Column) -> Column:
    return F.coalesce(sentence.rlike(SENTENCE), F.lit(False)) & checksum_valid(sentence)


class _Bits:
    def __init__(self, payload: str, fill: int):
        bits = []
        for c in payload:
            v = ord(c) - 48
            v -= 8 if v > 40 else 0
            if not 0 <= v < 64:
                raise ValueError("not a payload character")
            bits.append(f"{v:06b}")
        text = "".join(bits)
        self.text = text[: len(text) - fill] if fill else text

    def unsigned(self, at: int, n: int) -> int:
        part = self.text[at : at + n]
        if len(part) < n:
            raise ValueError("payload is too short")
        return int(part, 2)

    def signed(self, at: int, n: int) -> int:
        v = self.unsigned(at, n)
        return v - (1 << n) if v >> (n - 1) else v


#: Message type: where speed, longitude, latitude, course and heading stand.
LAYOUT = {1: (50, 61, 89, 116, 128), 2: (50, 61, 89, 116, 128), 3: (50, 61, 89, 116, 128), 18: (46, 57, 85, 112, 124), 19: (46, 57, 85, 112, 124)}
NO_SPEED, NO_COURSE, NO_HEADING, NO_LONGITUDE, NO_LATITUDE = 1023, 3600, 511, 181, 91


def decode(sentences: list[str]) -> dict:
    """Type, MMSI, position, speed, course and heading of one report in one or several sentences; what is unavailable is None."""
    parts, total = {}, None
    for s in sentences:
        fields = s.rpartition("*")[0][1:].split(",")
        code = 0
        for c in s[1:].rpartition("*")[0]:
            code ^= ord(c)
        if len(fields) != 7 or f"{code:02X}" != s.rpartition("*")[2].upper():
            raise ValueError("not a valid sentence")
        n, k = int(fields[1]), int(fields[2])
        if total not in (None, n) or k in parts or not 1 <= k <= n:
            raise ValueError("sentences don't belong together")
        total, parts[k] = n, (fields[5], int(fields[6]))
    if not parts or len(parts) != total:
        raise ValueError("a sentence is missing")
    bits = _Bits("".join(parts[k][0] for k in sorted(parts)), parts[total][1])
    kind = bits.unsigned(0, 6)
    if kind not in LAYOUT:
        raise ValueError(f"message type {kind} holds no position")
    speed, lon, lat, course, heading = LAYOUT[kind]
    v, x, y, c, h = bits.unsigned(speed, 10), bits.signed(lon, 28) / 600_000, bits.signed(lat, 27) / 600_000, bits.unsigned(course, 12), bits.unsigned(heading, 9)
    some = abs(x) <= 180 and abs(y) <= 90
    return {
        "message_type": kind, "mmsi": f"{bits.unsigned(8, 30):09d}", "longitude": x if some else None, "latitude": y if some else None,
        "speed_knots": None if v == NO_SPEED else v / 10, "course_degrees": None if c >= NO_COURSE else c / 10, "heading_degrees": None if h >= 360 else float(h),
    }


@vectorised("struct<message_type: int, mmsi: string, longitude: double, latitude: double, speed_knots: double, course_degrees: double, heading_degrees: double, fault: string>")
def decode_reports(sentences: pd.Series) -> pd.DataFrame:
    """Reports of arrays of sentences; `fault` says why one can't be read."""
    names = ["message_type", "mmsi", "longitude", "latitude", "speed_knots", "course_degrees", "heading_degrees"]

    def one(s):
        try:
            return [*decode(list(s)).values(), None]
        except (ValueError, TypeError, IndexError) as e:
            return [None] * 7 + [str(e)]

    return pd.DataFrame([one(s) for s in sentences], columns=[*names, "fault"]).astype({"message_type": "Int32"})


def mmsi(value: Column) -> Column:
    """Nine digits from a number or from text, else null."""
    text = value.cast("string")
    return F.when(text.rlike(r"\A[0-9]{9}\z"), text)
