"""Evidence rules: which words affirm, exclude or deny, as one configuration of word lists.

A text is read by a lexicon: every known word or phrase becomes one sign, and what
is left is not known. The rules are sets of kinds, not sequences:

- a negator denies the next marker if only fillers stand between them, and a status
  word denies the marker before it;
- a clause is about its subject if, once markers and settled denials are taken out,
  every word left is of a permitted kind, in any order; or if it is a note on the
  release, which may name anything.

Another corpus passes its own lists.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

# The words that decide what counts as evidence, by kind.
LEXICON: dict[str, tuple[str, ...]] = {
    "first": ("profile 7", "profile-7", "profile7", "p7"),
    "second": ("fel",),
    "rival": ("mel",),
    "excluded": ("remux",),
    "sound": (
        "truehd atmos", "truehd", "dts-hd ma", "dts-hd master audio", "dts:x", "e-ac-3 atmos", "eac-3 atmos", "e-ac3 atmos", "eac3 atmos",
        "e-ac-3", "eac-3", "e-ac3", "eac3", "dd+ atmos", "dd+",
    ),
    "picture": ("dolby vision", "dv"),
    "scan": ("mediainfo", "bdinfo", "disc scan", "source", "scan", "proof"),
    "layer": ("full enhancement layer", "enhancement layer", "layer"),
    "video": ("video",),
    "thing": ("blu-ray", "bluray", "uhd", "4k", "ultra hd", "disc", "edition"),
    "track": ("track", "tracks"),
    "absent": ("none", "false", "absent", "unsupported", "not present", "not supported"),
    "never": ("never",),
    "not_only": ("not only",),
    "not": ("not",),
    "no": ("no",),
    "without": ("without",),
    "do": ("does", "do"),
    "own": ("include", "feature", "have"),
    "hold": ("support", "contain", "provide", "identify"),
    "owns": ("has", "with", "features", "includes"),
    "be": ("is", "are"),
    "was": ("was", "were"),
    "confirmed": ("confirmed",),
    "shown": ("verified", "proven"),
    "confirms": ("confirms", "confirm"),
    "also": ("also",),
    "by": ("by", "via", "from"),
    "as": ("as",),
    "to_be": ("to be",),
    "link": ("to", "be", "only"),
    "article": ("a", "an", "the"),
    "any": ("any",),
    "release": ("release",),
    "english": ("english",),
    "definitely": ("definitely",),
    "doubt": ("doubt",),
    "it": ("it",),
    "yes": ("yes",),
    "released": ("released",),
    "note": ("release",),
    "aside": ("parenthetically",),
}
#: Kinds whose words count in lower case only.
AS_WRITTEN = ("released", "note", "aside")
#: Signs stand in a range of characters that no text uses.
SIGNS = {kind: chr(0xE100 + i) for i, kind in enumerate(LEXICON)}
DEVICES = (
    "ugoos", "zidoo", "homatics", "minix", "reavon", "magnetar", "panasonic", "amlogic", "realtek", "mediatek", "nvidia", "chromecast", "coreelec", "madvr", "hdfury",
    "dune hd", "apple tv", "fire tv", "fire stick", "android tv", "google tv", "shield tv", "shield pro", "s922x", "rtd 1619", "z9x", "am6", "am6b", "am6 plus", "am6b plus",
)
#: Model names with a number: the brand, and how many digits follow.
MODELS = (("oppo", 2, 3), ("oppo udp", 2, 3), ("oppo bdp", 2, 3), ("uhd", 4, 4))
DEVICE_WORDS = ("hardware", "player", "splitter", "device", "set-top")
BANNED_WORDS = ("hardware", "player", "splitter", "profile", "dolby vision", "device")
BINDING = ("is", "are", "has", "features", "includes", "confirmed as", "confirmed to be")
DEICTIC = ("this", "that", "these", "those", "it", "they", "he", "she", "we", "i", "you")
DAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DELIMITERS = ":,;/|&+•"
EDGES = " \t:;,.!?()[]{}'\"–—-"


def phrase_pattern(phrases: tuple[str, ...], any_case: bool = True) -> str:
    """Any of the phrases as whole words, spaces in them being any white space; the longest first."""
    ordered = sorted(phrases, key=len, reverse=True)
    body = "|".join(r"\s+".join(re.escape(w) for w in p.split()) for p in ordered)
    return f"{'(?i)' if any_case else ''}(?<![A-Za-z0-9])(?:{body})(?![A-Za-z0-9])"


def spelled(pattern: str) -> str:
    """A pattern over kinds, written <kind>, as one over signs."""
    return re.sub(r"<(\w+)>", lambda m: SIGNS[m[1]], pattern)


def one_of(*kinds: str) -> str:
    return "[" + "".join(f"<{k}>" for k in kinds) + "]"


_POINTS = "[:=?–—-]?"
_YEAR = "(?:19|20)[0-9]{2}"


@dataclass(frozen=True)
class EvidenceRules:
    """Two markers that must stand in one clause, and the kinds of words that may stand beside them or deny them."""

    #: Deny the next marker.
    negators: tuple[str, ...] = ("no", "not", "never", "without")
    #: May stand between a negator and the marker it denies.
    fillers: tuple[str, ...] = ("article", "any", "own", "hold", "confirmed", "shown", "as", "to_be", "picture", "first", "video", "layer")
    #: Deny the marker before them, and may follow a verb.
    statuses: tuple[str, ...] = ("no", "absent")
    verbs: tuple[str, ...] = ("be",)
    #: May stand beside the markers.
    permitted: tuple[str, ...] = (
        "picture", "video", "thing", "layer", "sound", "english", "track", "release", "note", "article", "as", "to_be", "link", "not_only",
        "be", "owns", "own", "also", "confirmed", "confirms", "shown", "by", "scan", "definitely", "it", "yes", "aside",
    )
    #: Notes on the release: what may follow the word for it.
    notes: tuple[str, ...] = field(default=("<released>", "<released>theatrically", f"<released>in{_YEAR}", "<released><by>.+", f"<note>(?:date|year){_YEAR}", "<note>(?:label|<thing>).+"))

    def _denies(self, marker: str) -> str:
        return f"{one_of(*self.negators)}{one_of(*self.fillers)}*<{marker}>|<{marker}>{_POINTS}{one_of(*self.verbs)}*{one_of(*self.statuses)}"

    @cached_property
    def denied(self) -> str:
        return spelled(self._denies("second"))

    @cached_property
    def rival_denied(self) -> str:
        return spelled(self._denies("rival"))

    @cached_property
    def settled(self) -> str:
        """Denials that speak for the subject: of the rival, and of doubt."""
        return spelled(f"{self._denies('rival')}|<no><doubt>")

    @cached_property
    def whole(self) -> str:
        return spelled(f"^(?:[{re.escape(EDGES)}]|{one_of(*self.permitted)})*$|^(?:{'|'.join(self.notes)})$")


DEFAULT = EvidenceRules()
