from chatlake.formats.base import Format
from chatlake.formats.registry import FORMATS, list_formats, load_format

__all__ = ["FORMATS", "Format", "list_formats", "load_format"]
