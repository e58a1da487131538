"""Constants of the classification: fixed values that results depend on, and the names a corpus may set."""

from __future__ import annotations

from dataclasses import dataclass

#: Stands for verse lines at the end of a hierarchy.
LINE = "line"

#: Subclass to its citation units, outermost first.
HIERARCHY = {
    "drama-act-scene-line": ("act", "scene", LINE),
    "drama-line": (LINE,),
    "prose-book": ("book",),
    "prose-book-chapter": ("book", "chapter"),
    "prose-book-letter": ("book", "letter"),
    "prose-book-section": ("book", "section"),
    "prose-chapter": ("chapter",),
    "prose-chapter-section": ("chapter", "section"),
    "prose-chapter-verse": ("chapter", "verse"),
    "prose-commentary-section": ("commentary", "section"),
    "prose-epistle": ("epistle",),
    "prose-fragment": ("fragment",),
    "prose-paragraph": ("paragraph",),
    "prose-section": ("section",),
    "prose-standard": ("book", "chapter", "section"),
    "verse-book-line": ("book", LINE),
    "verse-book-poem-line": ("book", "poem", LINE),
    "verse-poem-line": ("poem", LINE),
    "verse-stichic": (LINE,),
}
FAMILY_DEFAULT = {"drama": "drama-line", "prose": "prose-standard", "verse": "verse-stichic"}

#: Literary genres and the structural subclass each suggests.
LITERARY = {
    "attic-comedy": "drama-line",
    "attic-tragedy": "drama-line",
    "early-modern-drama": "drama-act-scene-line",
    "prose-biography": "prose-standard",
    "prose-dialogue": "prose-standard",
    "prose-epistolary": "prose-standard",
    "prose-geography": "prose-standard",
    "prose-historiography": "prose-standard",
    "prose-oratory": "prose-standard",
    "prose-philosophy": "prose-standard",
    "roman-comedy": "drama-line",
    "roman-tragedy": "drama-line",
    "verse-didactic": "verse-stichic",
    "verse-elegiac": "verse-stichic",
    "verse-epic": "verse-book-line",
    "verse-epigram": "verse-stichic",
    "verse-iambic": "verse-stichic",
    "verse-lyric-choral": "verse-stichic",
    "verse-lyric-monodic": "verse-stichic",
    "verse-lyric-pindaric": "verse-stichic",
    "verse-satiric": "verse-stichic",
}
#: Div types that are no citation units, attributes whose values are surveyed, limits.
WRAPPERS = ("edition", "translation", "textpart")
VALUE_ATTRIBUTES = ("type", "subtype", "unit", "met", "rend", "place", "role", "ident", "ed", "lang")
TOP_VALUES = 30
VALUE_LENGTH = 200


@dataclass(frozen=True)
class Names:
    """What a corpus calls its genre scheme and its schemas."""

    scheme: str = "#genre"
    schema_base: str = "https://example.org/schemas/"
    schema_prefix: str = "corpus_"
    resp: str = "#normalizer"


NAMES = Names()
