"""Field names of a record; every job takes them as parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Fields:
    id: str = "id"
    lang: str = "lg"
    type: str = "tp"
    length: str = "len"
    text: str = "ft"
    title: str = "title"
    year: str = "year"
    label: str = "ad_class"
    keywords: str = "keywords"
    quality: str = "ocrqa"


DEFAULT = Fields()
