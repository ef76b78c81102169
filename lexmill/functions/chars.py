"""Character classes as regular-expression class bodies (without brackets), valid for Java and RE2."""

# The code-point ranges and sets of the data cleaning conventions served here.
CHINESE = "\u4e00-\u9fa5"
CHINESE_PUNCTUATION = "，。？！：；、‘’“”《》〈〉（）…─～—·．「」『』〔〕【】□→×▲●〜"
ASCII_PRINTABLE = "!-~"
ALLOWED_RANGES = {
    "space": " \\t\\r\\n",
    "ascii printable": "!-~",
    "latin 1 supplement": "\u0080-\u00fe",
    "chinese": CHINESE,
    "chinese punctuation": CHINESE_PUNCTUATION,
    "latin extended a": "\u0100-\u017f",
    "latin extended b": "\u0180-\u024f",
    "greek and coptic": "\u0370-\u03ff",
    "general punctuation": "\u2000-\u206f",
    "super- and subscripts": "\u2070-\u209f",
    "currency": "\u20a0-\u20cf",
    "letter-like": "\u2100-\u214f",
    "number forms": "\u2150-\u218f",
    "math operators": "\u2200-\u22ff",
    "enclosed alphanumerics": "\u2460-\u24ff",
    "math operators supplement": "\u2a00-\u2aff",
    "enclosed cjk": "\u3220-\u3229\u3251-\u325f\u3280-\u3289\u32b1-\u32bf",
    "cjk compatibility": "\u3371-\u3376\u3380-\u33dd",
    "half and full width": "\uff01-\uff64\uffe0-\uffe2\uffe5\uffe6",
}
ALLOWED = "".join(ALLOWED_RANGES.values())
LINE_SEPARATORS = "\u2028\u2029\n\x0b\x0c\r\x1c\x1d\x1e"
#: White space of ``str.strip`` that ``trim`` leaves.
STRIPPED = "\\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u001c-\u001f"
#: The same characters one by one, and as a class for Java alone: a table for Latin-1, and a single test that other characters
#: fail before the rare ones are compared.
STRIPPED_CHARACTERS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
STRIPPED_JAVA = "".join(f"\\u{ord(c):04x}" for c in STRIPPED_CHARACTERS if ord(c) < 256) + "[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
PAIRS = ['""', "{}", "[]", "()", "‘’", "“”", "《》", "｛｝", "（）"]

FULL_WIDTH = "".join(map(chr, [*range(0xFF01, 0xFF5F), *range(0xFFE0, 0xFFE7)]))
HALF_WIDTH = "".join(map(chr, range(0x21, 0x7F))) + "¢£¬¯¦¥₩"

#: Characters whose capital form is several characters, and the single one of each: itself where there is none.
LONG_UPPER = "".join(c for c in map(chr, range(0x10000)) if len(c.upper()) > 1)
SINGLE_UPPER = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in LONG_UPPER)
