"""Substitution lists of the line rules: (pattern, replacement) in the order in which they apply.

Patterns are in Python's notation, ignore case unless the rule is in ``CASE_SENSITIVE``, and use ASCII classes.
"""

# Results must equal those of the data conventions served here, down to their quirks.
_BULLETS = "－・•￭■□♦◦●○◊►√∗*＊"
_ENCLOSED = "①②③④⑤⑥⑦⑧⑨⑩ⓐⓑⓒⓓⓔⓕⓖⓗⓘⓙⓚⓛⓜⓝⓞⓟⓠⓡⓢⓣⓤⓥⓦⓧⓨⓩⅰⅱⅲⅳⅴⅵⅶⅷⅸⅹⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫ⒈⒉⒊⒋⒌⒍⒎⒏⒐⒑⒒⒓⒔⒕⒖⒗⒘⒙⒚⒛⑴⑵⑶⑷⑸⑹⑺⑻⑼⑽⑾⑿⒀⒁⒂⒃⒄⒅⒆⒇"
_CURRENCIES = "rmb|cny|y|jpy|won|kpw|krw|hkd|mop|ntd|rbs|rs|rbl|rub|eur|euro|usd|chf|cad|aud|sgd|myr|idr|nzd|vnd|thb|php|dkk|sek|zar|brl"
_AMOUNT = r"(\d+(,\d+)*(\.\d+)? ?(m|million|bn|billion|trillion|tn)?)\b"
_URL_CHARS = r"[a-zA-Z0-9/\.@\-#\?&]"

COMMON = {
    "Separate_Number_Unit": [(r"\b(\d+(,\d+)*(\.\d+)?)([a-z]+)\b", r"\1 \4")],
    "Remove_Square_Content": [("（", "("), ("）", ")"), ("【", "("), ("】", ")"), ("<", "("), (">", ")"), (r"\([^\)]+\)", ""), (r"\(", ""), (r"\)", "")],
    "Remove_Single_Quotation": [("^'", ""), ("'$", ""), (r"'\t", "\t"), (r"([^s])'([ ,.?!])", r"\1 \2"), (r"([ ,.?!])'", r"\1"), (" '", " "), ("‘", ""), ("`", "")],
    "Remove_Bad_Begin": [(r"^[,.?!:;*#\-> ，。？！：；、]+", "")],
    "Remove_Special_Chars": [("[\u200b]", ""), ("[\ufeff]", ""), ("[\u2028]", "")],
    "Remove_Empty_Line": [(r"^\s\+\t.*", ")"), (r"^.*\t\s+$", ""), (r"^.*\t$", ""), (r"^\t.*", ""), (r"^.*-{5,}.*", "")],
    "Remove_Redundant_Spaces": [("^[ ]+", ""), ("[ ]+$", ""), ("[ ]+", " ")],
    "Norm_Ellipsis": [(p, "...") for p in (r"\?\.\?\.\?\. \?", r"\?\.\?\.\?\.\?\.", r"\?\.\?\.\?\.", r"\?\.\?\. \?\.", r"\.\?\.\?\.", r"\?\.\?\.", r"\. \. \.")],
    "Entity_URL": [(rf"https?://{_URL_CHARS}+", "<URL>"), (rf"www\.{_URL_CHARS}+", "<URL>"), (rf"(http://|https://)?{_URL_CHARS}+(\.com|\.net|\.edu|\.cn|\.org|\.info){_URL_CHARS}*", "<URL>")],
    "Entity_Digit_StyleA": [("[0-9]", "0")],
    "Remove_Consecutive_Dash_Or_Underscore": [(r"(\s?-\s?){2,}|(\s?_\s?){2,}", " ")],
    "BD_Recover": [("<B>(.) ", r"\1"), ("<M>(.) ", r"\1"), ("<M>(.) ", r"\1"), ("<E>(.)", r"\1")],
    "Remove_Heading_Numbers": [(r"^(20[0-9][0-9])", r"ccc\1"), (r"^(19[0-9][0-9])", r"ccc\1"), (r"^[0-9., ]+", ""), (r"^ccc(20[0-9][0-9])", r"\1"), (r"^ccc(19[0-9][0-9])", r"\1")],
}
ENGLISH = {
    "Remove_Bullet": [(rf"^((\d+|[xiv]+|[a-f{_BULLETS}②③]\])\s?\.|\(\s?(\d+|[xiv]+|[a-f])\)\s?\.?|((\d+|[a-z]+)\.)+(\d+|[a-z]+)\.?)", "")],
    "Remove_Bullet_v2": [(r"^((\d+|[xiv]+|[a-f])\.\s|\(?(\d+|[xiv]+|[a-f])\)|((\d+|[a-z]+)\.)+(\d+|[a-z]+)\.?\s)", ""), (f"^[{_BULLETS}{_ENCLOSED}]", "")],
    "Remove_Punctuation": [("\"|—|“|”|《|》", " ")],
    "Remove_Punctuation_v2": [("\"| - | — |“|”|《|》", " ")],
    "Replace_Chinese_Single_Quotation": [("’", "'"), ("“", '"'), ("”", '"')],
    "Replace_Chinese_Punctuation": [("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("【", "["), ("】", "]"), ("（", "("), ("）", ")"), ("，", ","), ("。", "."), ("？", "?"), ("！", "!")],
    "Dedupe_Repeated_Punctuation": [(rf"{p}{{2,}}", p.lstrip("\\")) for p in (",", r"\.", r"\?", "!", ";", ":", '"', "'", r"\(", r"\)", "-", "–", "—", "_")],
    "Separate_Currency_Number": [(rf"\b({_CURRENCIES}){_AMOUNT}", r"\1 \2"), (rf"\${_AMOUNT}", r"$ \1")],
    "Remove_Between_QuesMark": [(r"(\w)\?(\w)", r"\1\2")],
}
CHINESE = {
    "Remove_Bullet": [(rf"^((\d+|[xiv]+|[a-f{_BULLETS}②③]|[一二三四五六七八九十百]+)\s?(\.|、)|(\(|（|【)?\s?(\d+|[xiv]+|[a-f]|[一二三四五六七八九十百]+)\s?(\)|）|】)\s?(\.|、)?|((\d+|[a-z]+)\.)+(\d+|[a-z]+)\.?)", "")],
    "Remove_Punctuation": [("'|\"|-|—|“|”|《|》", " ")],
    "Remove_Punctuation_v2": [("\"| - |—|“|”|《|》", " ")],
    "Dedupe_Repeated_Punctuation": [(f"{p}{{2,}}", p) for p in "，。？！；：“”‘’、·（）—–"],
    "Remove_Space": [(r"([a-zA-Z0-9\.])\s+([a-zA-Z0-9])", r"\1==KEEP==\2"), (" +", ""), ("==KEEP==", " ")],
    "Norm_Name": [(r"(\w)\?(\w)", r"\1 \2"), ("•", " "), ("·", " ")],
    "Remove_Translator_Note": [(r"\([^\)]+译者注\)", ""), ("（[^）]+译者注）", ""), (r"^.*\t译者.*", "")],
    "Remove_Pic_Note": [("^.*[^试]图.*", "")],
    "Split_Not_ChineseCharacter": [("([!-~]+)", r" \1 ")],
    "Remove_Chinese_Single_Quotation": [("‘s", "'s"), ("’s", "'s"), ("s‘", "s'"), ("s’", "s'"), ("‘", ""), ("’", "")],
}
CASE_SENSITIVE = {"BD_Recover"}

#: Bullets of the second Chinese rule: text bullets (not before a decimal), then symbols.
CHINESE_BULLETS = r"^((\d+|[xiv]+|[a-f]|[一二三四五六七八九十百]+)(\.|、)|(\(|（|【)?(\d+|[xiv]+|[a-f]|[一二三四五六七八九十百]+)(\)|）|】)|((\d+|[a-z]+)\.)+(\d+|[a-z]+)\.?)"
CHINESE_SYMBOL_BULLETS = f"^[{_BULLETS}{_ENCLOSED}㈠㈡㈢㈣㈤㈥㈦㈧㈨㈩]"

#: Number shapes: groups by comma, by blank, plain.
_SHAPES = (r"\b\d{1,3}(,\d{3})+(\.\d+)?", r"\b\d{1,3}( \d{3})+(\.\d+)?", r"\b\d+(\.\d+)?")
_UNITS = "(m|million|bn|billion|trillion|tn)"
ENGLISH_NUMBERS = [s + rf"( ?{_UNITS})?\b" for s in _SHAPES]
ENGLISH_AMOUNTS = [s + rf" ?{_UNITS}\b" for s in _SHAPES]
CHINESE_AMOUNTS = [s + r"\s*(万亿|万|亿)" for s in _SHAPES]
CHINESE_NUMBERS = [s + r"\b" for s in _SHAPES]
CHINESE_MONTH = r"\d+\s*月"
TAGGED = r"<([A-Za-z]+)>[^<]+</\1>"
NOT_TRANSLATED = [
    r"http[:：]//[a-zA-Z0-9\-_~\*\'@&=\+\$/\?#\.]+[a-zA-Z0-9/#]",
    r"(www\.[A-Za-z0-9\-_~\*\'@&=\+\$/\?#\.]+[a-zA-Z0-9/#])",
    r"(([A-Za-z0-9\.-]+\.[A-Za-z0-9-]+|[A-Za-z]+)@[A-Za-z0-9\.-]+[A-Za-z])",
]
PROTECTED_URL = r"https?[:：]//[a-z0-9\-_~\*\'@&=\+\$/\?#]+[a-zA-Z0-9/#]"
CASED_WORD = r"\b[A-Za-z0-9]+[A-Za-z0-9\'.:_\-&]\b"
