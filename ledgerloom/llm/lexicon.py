"""Phrases and remarks of the shop floor that spelling alone cannot explain."""

from dataclasses import dataclass, field

# Other ways, in English and Hindi, to say a reason of rejection.
REASON_PHRASES = (
    ("sharp edge left after cutting", "Burr on cut edge"),
    ("kinare pe burr", "Burr on cut edge"),
    ("bore too big", "Hole oversize"),
    ("hole bada hai", "Hole oversize"),
    ("bore too small", "Hole undersize"),
    ("hole chhota hai", "Hole undersize"),
    ("not drilled", "Hole missing"),
    ("hole nahi hai", "Hole missing"),
    ("threads worn away", "Thread stripped"),
    ("chudi kharab", "Thread stripped"),
    ("no tapping done", "Thread not formed"),
    ("chudi nahi bani", "Thread not formed"),
    ("joint split along bead", "Weld crack"),
    ("weld me darar", "Weld crack"),
    ("groove beside bead", "Weld undercut"),
    ("bead ke paas gaddha", "Weld undercut"),
    ("gas pores seen in bead", "Porosity in weld"),
    ("weld me chhed", "Porosity in weld"),
    ("bead not on joint line", "Weld bead offset"),
    ("bead line se bahar", "Weld bead offset"),
    ("joint not melted through", "Lack of fusion"),
    ("joint juda nahi", "Lack of fusion"),
    ("sheet melted open", "Burn through"),
    ("sheet jal gayi", "Burn through"),
    ("sagging coat drops", "Paint run"),
    ("paint beh gaya", "Paint run"),
    ("paint patla", "Paint thin"),
    ("low film thickness", "Paint thin"),
    ("blotchy coat", "Paint patch uneven"),
    ("paint ek jaisa nahi", "Paint patch uneven"),
    ("film lifting off", "Coating flaking"),
    ("coating utar rahi", "Coating flaking"),
    ("cloudy spots after bath", "Plating stain"),
    ("plating pe daag", "Plating stain"),
    ("tiny craters in chrome", "Plating pitted"),
    ("plating me gaddhe", "Plating pitted"),
    ("under micron nickel", "Nickel layer low"),
    ("nickel kam", "Nickel layer low"),
    ("dark chrome at high current", "Chrome burn"),
    ("chrome jala hua", "Chrome burn"),
    ("red oxide seen", "Corrosion on surface"),
    ("zang laga", "Corrosion on surface"),
    ("line mark from stacking", "Handling scratch"),
    ("uthane me kharonch", "Handling scratch"),
    ("impact hollow", "Deep dent"),
    ("bada gaddha", "Deep dent"),
    ("pipe turned on axis", "Tube twisted"),
    ("pipe ainth gaya", "Tube twisted"),
    ("pipe not round", "Tube ovality high"),
    ("pipe gol nahi", "Tube ovality high"),
    ("gauge of sheet short", "Wall thickness low"),
    ("mota kam", "Wall thickness low"),
    ("cut under size", "Length short"),
    ("lambai kam", "Length short"),
    ("cut over size", "Length excess"),
    ("lambai zyada", "Length excess"),
    ("not matching angle gauge", "Bend angle wrong"),
    ("mod galat", "Bend angle wrong"),
    ("rocks on surface plate", "Flatness not ok"),
    ("plate pe hilta hai", "Flatness not ok"),
    ("bracket off location pin", "Bracket shifted"),
    ("bracket khisak gaya", "Bracket shifted"),
    ("nut fell loose", "Nut not welded"),
    ("nut gir gaya", "Nut not welded"),
    ("bush dheela", "Bush loose"),
    ("sleeve turning free", "Bush loose"),
    ("rivet not set", "Rivet head open"),
    ("rivet khula", "Rivet head open"),
    ("weak return force", "Spring tension low"),
    ("spring kamzor", "Spring tension low"),
    ("two models in one bin", "Mixed lot"),
    ("do model mile", "Mixed lot"),
    ("other item delivered", "Wrong part supplied"),
    ("galat part aaya", "Wrong part supplied"),
    ("layered steel", "Raw material lamination"),
    ("material me parat", "Raw material lamination"),
    ("over hrc limit", "Material hardness high"),
    ("material sakht", "Material hardness high"),
    ("under hrc limit", "Material hardness low"),
    ("material naram", "Material hardness low"),
    ("tool impression line", "Die mark"),
    ("die ka nishan", "Die mark"),
    ("punch skidded", "Tool slip mark"),
    ("punch fisal gaya", "Tool slip mark"),
    ("folds in drawn cup", "Wrinkle at draw"),
    ("silvat", "Wrinkle at draw"),
    ("sheet ripped at radius", "Tear at corner"),
    ("kone pe fata", "Tear at corner"),
    ("buff trace visible", "Polish wheel line"),
    ("polish ki line", "Polish wheel line"),
    ("rubber ring not fitted", "Grommet absent"),
    ("rubber nahi laga", "Grommet absent"),
    ("gum oozing out", "Sealant leak"),
    ("gum bah raha", "Sealant leak"),
    ("first piece of setting", "Setup piece"),
    ("setting ka piece", "Setup piece"),
)

# Remarks written beside a reason or an item that don't belong to it (patterns on folded text).  A value is
# also read with them, so none needs an exception for an entry that has such words.
REMARKS = (
    r"\bat line \d+\b", r"\bafter wash\b", r"\bshift [a-z]\b", r"\brework\b", r"\bqa\b", r"\bagain\b", r"\bseen\b", r"\bfound\b",
    r"#\d+", r"\blot \d+\b", r"\btray \d+\b", r"\b\d+ pcs?\b", r"\bpc\b", r"\bno tag\b", r"\bmodel [a-z]\b", r"\bnew\b", r"\bold\b",
)

# Trades of firms, each with the ways it is shortened.
_TRADES = {
    "autoparts": ("autoparts", "autopart", "auto", "parts", "pts"),
    "castings": ("castings", "casting", "cstgs", "cstg", "cast"),
    "engineering": ("engineering", "engineers", "enginering", "engg", "engrg", "eng", "engr"),
    "enterprises": ("enterprises", "enterprise", "enterprizes", "entp", "ent", "entpr"),
    "fasteners": ("fasteners", "fastener", "fastners", "fast", "fstnrs"),
    "industries": ("industries", "industry", "inds", "ind", "indus"),
    "metalworks": ("metalworks", "metalwork", "metal", "works", "wks"),
    "polymers": ("polymers", "polymer", "poly"),
    "springs": ("springs", "spring", "sprgs", "sprg", "spr"),
    "stampings": ("stampings", "stamping", "stmpgs", "stmpg", "stmp"),
}

# Legal forms of firms (patterns on folded text) and what they are.
_LEGAL_FORMS = (
    (r"\bl\.? ?l\.? ?p\b\.?", "llp"),
    (r"\(?\bp(?:vt|rivate)?\b\.?\)? *(?:ltd|limited)\b\.?", "pvt"),
    (r"\b(?:ltd|limited)\b\.?", "ltd"),
    (r"(?:\band\b|&)? *\bson'?s\b", "sons"),
    (r"(?:\band\b|&)? *\b(?:company|co)\b\.?", "co"),
)
_FORM_OF_ADDRESS = r"^ *(?:m/s|messrs)\b\.?"

# Other names of one party.
_NAME_ALIASES = (("self make", "own shop"), ("self made", "own shop"), ("in house", "own shop"))


@dataclass(frozen=True)
class FirmLexicon:
    """What is known beforehand about the names of firms; all of it may be empty.

    ``trades`` and the ways each is written, ``halves`` of trades written in two words, ``legal_forms`` (pattern on folded
    text, form), the pattern of a form of ``address``, and ``aliases`` (another name, the name meant).
    """

    trades: dict[str, tuple[str, ...]] = field(default_factory=dict)
    halves: dict[str, tuple[str, str]] = field(default_factory=dict)
    legal_forms: tuple[tuple[str, str], ...] = ()
    address: str = ""
    aliases: tuple[tuple[str, str], ...] = ()


FIRMS = FirmLexicon(_TRADES, {"metalworks": ("metal", "works"), "autoparts": ("auto", "parts")}, _LEGAL_FORMS, _FORM_OF_ADDRESS, _NAME_ALIASES)
