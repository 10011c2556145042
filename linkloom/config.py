"""Fixed values and tunables of the blocking engine."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must be these for right results.
NAME_ABBREVIATIONS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated",
    "llp": "limited liability partnership", "llc": "limited liability company", "&": "and",
}
ADDRESS_ABBREVIATIONS = {"rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "no": "number", "kh": "khasra"}
STOP_WORDS = ["private", "limited", "corporation", "company", "incorporated", "and", "the", "of"]
NAME_BLOCK_STOP = ["liability", "partnership", "llc", "llp", "pc", "lp", "plc", "com", "www", "net", "org", "http", "https", "प्राइवेट", "प्रा", "लिमिटेड", "लि"]
ADDRESS_GENERIC = [
    "street", "road", "avenue", "drive", "lane", "boulevard", "court", "place", "way", "circle", "highway", "suite", "unit", "floor",
    "number", "near", "null", "none", "door", "h", "flat", "building", "apartment", "plot", "opp", "east", "west", "north", "south",
    "n", "s", "e", "w", "the", "of", "and", "st", "rd", "nagar",
]
LOOKALIKE_DIGITS, LOOKALIKE_LETTERS = "013548", "olesab"

SEPARATOR = "\x1f"
NAME_TOKEN, NAME_PAIR, NAME_CONCAT, ADDRESS_PAIR = 1, 2, 3, 4
KEY_TYPES = (NAME_TOKEN, NAME_PAIR, NAME_CONCAT, ADDRESS_PAIR)


@dataclass(frozen=True)
class BlockingConfig:
    """bucket_cap: keys of more records are dropped. fanout_budget: postings expanded for a
    reference record, rarest keys first (None: all). top_n: candidates kept (None: all)."""

    bucket_cap: int = 2000
    fanout_budget: int | None = 300
    top_n: int | None = 50
    key_types: tuple[int, ...] = KEY_TYPES
    weights: dict[int, float] = field(default_factory=lambda: dict.fromkeys(KEY_TYPES, 1.0))
    name_pair_tokens: int = 6
    address_tokens: int = 12
    concat_length: int = 6


DEFAULT = BlockingConfig()
