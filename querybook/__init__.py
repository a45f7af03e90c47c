"""All registered queries over the given tables."""

from . import companies, pages, phones, reach, search, sites, urls  # noqa: F401
from .base import BOOK

__all__ = ["BOOK"]
