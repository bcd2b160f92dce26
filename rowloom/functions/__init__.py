from rowloom.functions.composite import composite, in_composite_range
from rowloom.functions.text import key_part, split_parts, state_key, text, words

__all__ = ["composite", "in_composite_range", "key_part", "split_parts", "state_key", "text", "words"]
