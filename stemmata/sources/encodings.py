"""In which encoding a document's bytes are."""

from __future__ import annotations

import codecs
import re

_DECLARED = re.compile(rb"""\A<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z][A-Za-z0-9._-]*)["']""")
#: What an XML parser reads by itself, with or without a byte order mark.
_OWN = {"utf-8", "utf-16", "utf-16-le", "utf-16-be"}


def readable(xml: str | bytes) -> str | bytes:
    """What a parser can be given: text as it is (its declaration, if any, no longer holds), bytes of a declared encoding as text, other bytes as they are.

    Raises ValueError or LookupError where bytes aren't in the encoding that they declare, or nobody knows it."""
    if isinstance(xml, str):
        return xml
    found = _DECLARED.match(xml)
    if not found:
        return xml
    name = codecs.lookup(found[1].decode()).name
    return xml if name in _OWN else xml.decode(name)
