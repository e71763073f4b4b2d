"""Label-rescue rule packs as data.

A pack is an ordered list of stages; a stage is an ordered list of rules;
within a stage the first rule whose detector matches rewrites the value
(first match wins) and stages run one after another on the same value.

Rule forms (detector is a regex searched anywhere in the value):
  (detect, "sub", pattern, replacement)   replace all matches; groups as \\1
  (detect, "null")                         value becomes null
  (detect, "append", text)                 value + text
  (detect, "prefix", n)                    first n characters
  (detect, "prefix_append", n, text)       first n characters + text
  (detect, "tr", from_chars, to_chars)     character map
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (label grammar and rules).
# Patterns are kept verbatim in source order; one deliberate change is
# marked D6 (AM instead of PM for the "11;4AM" repair).
# ---------------------------------------------------------------------------

# Classification of path components (first match wins; unknown -> None)
DATE_COMPONENT = r"^\d{8}$"
PARTICIPANT_COMPONENT = r"^\d{5,6}([MC][MC]?)?$"      # D3: two letters allowed (-> B)
CATEGORY_COMPONENT = r"^[0-9_]+\. "
TYPE_COMPONENTS = ("Birth_follow_up_mother", "Mother", "Birth_follow_up_child", "Child")

# R2: several windows in one label -> tab-separated (detectors read the
# value before any rewrite; each rewrite applies when its detector fired)
SPLIT_RULES = [
    (r"\d{1,2} ?([AP]M)?-?\s+,?\d{5,6}[CM]?[CM]? ?_", "sub",
     r"(\d{1,2}) ?([AP]M)?-?\s+,?(\d{5,6}[CM]?[CM]?) ?(_)", "\\1\\2\t\\3\\4"),
    (r"\d{2} ?([AP]M)?\([A-Z0-9 ]+\)\s+\d{5,6}[CM]?[CM]?_", "sub",
     r"(\d{2}) ?([AP]M)?\(([A-Z0-9 ]+)\)\s+(\d{5,6}[CM]?[CM]?_)", "\\1\\2(\\3)\t\\4"),
    (r"^\d{5},\d{5}$", "tr", ",", "\t"),
    (r"^PID[A-Z0-9]+  PID[A-Z0-9]+$", "sub", r"\s+", "\t"),
    (r"\d{1,2} ?([AP]M)?\s+,?\d{5,6}[CM]?[CM]? ?-", "sub",
     r"(\d{1,2}) ?([AP]M)?\s+,?(\d{5,6}[CM]?[CM]?) ?(-)", "\\1\\2\t\\3_"),
]
UNSPLIT_LABEL = r"\s{2,}"          # >= 2 blanks left without a tab: unhandled

# Repair of one window label (character maps, then nine stages)
LABEL_CHAR_MAP = (".,'", ";;;")
REPAIR_STAGES = [
    [  # ids, suffixes, null-outs
        (r"\d{1,2}'\d{2}[AP]M", "tr", "'", ";"),
        (r"^\d{5,6}_", "sub", r"^(\d{5,6})_", "\\1M_"),
        (r"\d{2}[AP]M;\d{1,2};\d{2}[AP]M", "sub", r"(\d{2}[AP]M);(\d{1,2};\d{2}[AP]M)", "\\1-\\2"),
        (r"^\d{5}$", "append", "M"),
        (r"^SL_", "null"),
        (r"^PIDGT", "null"),
    ],
    [  # delimiters
        (r"-\d{4}[AP]M", "sub", r"(-\d{2})(\d{2}[AP]M)", "\\1;\\2"),
        (r"_\d{1,2};\d{2}[AP]M;\d{1,2};\d{2}[AP]M$", "sub",
         r"(_\d{1,2};\d{2}[AP]M);(\d{1,2};\d{2}[AP]M)$", "\\1-\\2"),
        (r"\d{2};[AP]M", "sub", r"(\d{2});([AP]M)", "\\1\\2"),
        (r"[AP]M_\d{1,2};", "sub", r"([AP]M)_(\d{1,2};)", "\\1-\\2"),
        (r"-\d{1,2}-\d{2}[AP]M", "sub", r"(-\d{1,2})-(\d{2}[AP]M)", "\\1;\\2"),
        (r"^\d{5,6}[CM]\d{1,2};\d{2}[AP]M", "sub", r"^(\d{5,6}[MC])(\d{1,2};\d{2}[AP]M)", "\\1_\\2"),
        (r"\d{1,2};\d{2}[AP]M\d{1,2};\d{2}", "sub", r"(\d{1,2};\d{2}[AP]M)(\d{1,2};\d{2})", "\\1-\\2"),
    ],
    [  # missing meridians
        (r"_0?\d;\d{2}-0?\d;\d{2}PM", "sub", r"_(0?\d;\d{2})(-0?\d;\d{2}PM)", "_\\1PM\\2"),
        (r"_0?\d;\d{2}PM-0?\d;\d{2}\s*$", "sub", r"_(0?\d;\d{2}PM)(-0?\d;\d{2})", "_\\1\\2PM"),
        (r"_1[01];\d{2}-1[01];\d{2}AM", "sub", r"_(1[01];\d{2})(-1[01];\d{2}AM)", "_\\1AM\\2"),
        (r"_1[01];\d{2}AM-1[01];\d{2}\s*$", "sub", r"_(1[01];\d{2}AM)(-1[01];\d{2})", "_\\1\\2AM"),
    ],
    [  # ranges
        (r"_\d{1,2};\d{2}[AP]M\d{1,2};\d{2}[AP]M", "sub",
         r"_(\d{1,2};\d{2}[AP]M)(\d{1,2};\d{2}[AP]M)", "_\\1-\\2"),
        (r"_\d{1,2};\d{2}-[AP]M\d{1,2};\d{2}[AP]M", "sub",
         r"_(\d{1,2};\d{2})-([AP]M)(\d{1,2};\d{2}[AP]M)", "_\\1\\2-\\3"),
    ],
    [  # naked ranges
        (r"1[01];\d{2}-1[01];\d{2}$", "sub", r"(1[01];\d{2})(-1[01];\d{2})", "\\1AM\\2AM"),
        (r"12;\d{2}-12;\d{2}$", "sub", r"(12;\d{2})(-12;\d{2})", "\\1PM\\2PM"),
    ],
    [  # midday
        (r"12;\d{2}PM-(12|0?1);\d{2}$", "sub", r"(12;\d{2}PM-(?:12|0?1);\d{2})$", "\\1PM"),
        (r"12;\d{2}-(12|0?1);\d{2}PM\s*$", "sub", r"(12;\d{2})(-(?:12|0?1);\d{2}PM)\s*$", "\\1PM\\2"),
        (r"11;\d{2}AM-11;\d{2}$", "sub", r"(11;\d{2}AM-11;\d{2})$", "\\1AM"),
        (r"11;\d{2}-11;\d{2}AM$", "sub", r"(11;\d{2})(-11;\d{2}AM)$", "\\1AM\\2"),
        (r"11;\d{2}AM-12;\d{2}$", "sub", r"(11;\d{2}AM-12;\d{2})$", "\\1PM"),
        (r"11;\d{2}-12;\d{2}PM$", "sub", r"(11;\d{2})(-12;\d{2}PM)$", "\\1AM\\2"),
    ],
    [  # stray blanks
        (r"^\d{5,6}[MC] _", "sub", r"^(\d{5,6}[MC]) _", "\\1_"),
        (r"^\d{5,6}[MC]_ ", "sub", r"^(\d{5,6}[MC])_ ", "\\1_"),
        (r"[-_]\d{1,2};\d{2} [AP]M", "sub", r"([-_]\d{1,2};\d{2}) ([AP]M)", "\\1\\2"),
        (r"[AP]M -\d{2};\d{2}", "sub", r"([AP]M) (-\d{2};\d{2})", "\\1\\2"),
    ],
    [  # ad-hoc repairs
        (r"^\d{5,6}M_.*\s+CHILD$", "sub", r"^(\d{5,6})M([^ ]*)\s+CHILD$", "\\1C\\2"),
        (r"^\d{5}M_C(HILD)?$", "sub", r"^(\d{5})M_C(HILD)?", "\\1C"),
        (r"^\d{5}M_M$", "prefix", 6),
        (r"^\d{5}M_BIRTH FOLLOWUP$", "prefix", 6),
        (r"PMP", "sub", r"PMP", "PM"),
        (r"^[2-9]\d{3}00[CM]", "sub", r"^([2-9]\d{3})0(0[CM])", "\\1\\2"),
        (r"-012", "sub", r"-012", "-12"),
        (r";031", "sub", r";031", ";31"),
        (r"110;4AM", "sub", r"110;4AM", "11;04AM"),
        (r"03;0PM", "sub", r"03;0PM", "03;09PM"),
        (r"11;4AM", "sub", r"11;4AM", "11;49AM"),          # D6 (reference: 11;49PM)
        (r"^\d{5}M_.*\(CHILD\)$", "sub", r"^(\d{5})M(_.*)\(CHILD\)", "\\1C\\2"),
        (r"-110;", "sub", r"-110;", "-11;0"),
        (r"_114;", "sub", r"_114;", "_11;4"),
        (r"-120;", "sub", r"-120;", "-12;"),
        (r"11;\d{2}PAM", "sub", r"11;(\d{2})PAM", "11;\\1AM"),
        (r"\s+TWIN BABY$", "sub", r"\s+TWIN BABY$", ""),
        (r"\(TWIN BABY\)$", "sub", r"\(TWIN BABY\)$", ""),
        (r"\(PREAGNANT WOMAN\)$", "sub", r"\(PREAGNANT WOMAN\)$", ""),
        (r"^\d{5} MOTHER", "prefix_append", 5, "M"),
        (r" MOTHER$", "sub", r"\s+MOTHER$", ""),
    ],
    [  # repeats for corner cases
        (r"12;\d{2}PM-12;\d{2}$", "sub", r"(12;\d{2}PM-12;\d{2})$", "\\1PM"),
        (r"12;\d{2}-12;\d{2}PM\s*$", "sub", r"(12;\d{2})(-12;\d{2}PM)\s*$", "\\1PM\\2"),
        (r"_0?\d;\d{2}-0?\d;\d{2}PM", "sub", r"_(0?\d;\d{2})(-0?\d;\d{2}PM)", "_\\1PM\\2"),
        (r"_0?\d;\d{2}PM-0?\d;\d{2}\s*$", "sub", r"_(0?\d;\d{2}PM)(-0?\d;\d{2})", "_\\1\\2PM"),
    ],
]

# Final grammar of a repaired label
LABEL_GRAMMAR = r"^1?\d{5}[CMB][CM]?(_\d{1,2};\d{2}[AP]M\-\d{1,2};\d{2}[AP]M(\([A-Z0-9 ]+\))?)?$"

# Parse of a repaired label
LABEL_PARTICIPANT = (r"^(\d{5,6}).*$", "\\1")
LABEL_TYPE = (r"^\d{5,6}([MCB]).*$", "\\1")             # D4: B accepted
LABEL_HAS_WINDOW = r"_\d{1,2};\d{2}[AP]M-\d{1,2};\d{2}[AP]M"
LABEL_START = (r"^.*_(\d{1,2};\d{2}[AP]M)-.*$", "\\1")
LABEL_END = (r"^.*-(\d{1,2};\d{2}[AP]M)(?:\(.*\))?$", "\\1")
LABEL_CATEGORY = [(r"\(6 MONTH.*$", 7), (r"\(28 DAYS.*$", 6), (r"\(3RD", 4)]
LABEL_PAREN = r"\(.*$"
LABEL_TIME = r"\d{1,2}:\d{2}[AP]M"

# Category folder text -> number ("6. Birth follow up" -> 6; D5: 10-12 too)
CATEGORY_TEXT = (r"^([0-9_]+)\..*", "\\1")

# Participant code folder -> participant and type suffix (two letters -> B)
CODE_PARTICIPANT = (r"^(\d{5,6}).*$", "\\1")
CODE_SUFFIX = r"([CM][CM]?)$"
BOTH_TYPES = ("MC", "CM")

# Free-text type -> letter (case-insensitive containment)
TYPE_WORDS = (("child", "C"), ("mother", "M"))

# R11 (older pack, optional): "all work was in daytime"
DAYTIME_RULES = [(r"12;(\d{2})AM", "12;\\1PM"), (r"11;(\d{2})PM", "11;\\1AM")]

# R12 (optional): parts of a repaired label, as (when it matches, pattern, group)
PART_DATES = [(r"^\d{8}$", r"^(\d{8})$", 1)]
PART_IDS = [
    (r"^(PID|SL_)", r"^(.*)$", 1),
    (r"^\d{5}[MCB]($|_)", r"^(\d{5})", 1),
    (r"^\d{6}[MCB]($|_)", r"^(\d{6})", 1),
]
PART_LETTER = r"^\d{5,6}([CMB])"
PART_WORDS = {"C": "child", "M": "mother", "B": "both"}
PART_WINDOWS = [
    (r"^\d{5,6}\w_\d{2}:", r".*(\d{2}:\d{2}[AP]M-\d{1,2}:\d{2}[AP]M)", 1),
    (r"^\d{5,6}\w_\d{1}:", r".*(\d{1}:\d{2}[AP]M-\d{1,2}:\d{2}[AP]M)", 1),
]
