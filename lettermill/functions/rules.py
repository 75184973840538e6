"""Cleaning rules as ordered tables."""

from __future__ import annotations

from .regexlib import Chain, Rule

_I = "i"

# Brackets and phrases of edit marks.
EDIT_PHRASES = ("This message was edited", "Message was edited", "Edited")
# Lines of quoted mail and of signatures that go if they stand alone, and what each holds in lower case.
QUOTE_LINES = (
    (r"On\s.+?wrote:", "wrote:"),
    (r"From:\s+.+?\s+Sent:\s+.+?\s+To:\s+.+?\s+Subject:\s+.+?", "subject:"),
    (r"From:\s+.+?\s+Date:\s+.+?\s+To:\s+.+?\s+Subject:\s+.+?", "subject:"),
    (r"Sent from my iPhone", "sent from my iphone"),
    (r"Sent from my iPad", "sent from my ipad"),
    (r"Get Outlook for iOS", "get outlook for ios"),
    (r"CONFIDENTIALITY CAUTION AND DISCLAIMER.*", "confidentiality caution"),
    (r"This message is intended only for.*", "this message is intended"),
    (r"All unintended recipients are obliged.*", "all unintended recipients"),
    (r"epam\.com", "epam.com"),
    (r"Mobile:\s+\+?\d+", "mobile:"),
    (r"Email:\s+[^\s]+", "email:"),
    (r"Minsk, Belarus", "minsk, belarus"),
)
# Closings that may stand on a line by themselves, and those a name may follow.
BARE_CLOSINGS = ("Best regards", "Thanks", "Thank you", "Sincerely", "Regards")
CLOSINGS = ("Best", "Thanks", "Thank you", "Best regards", "Regards", "Sincerely", "Cheers", "Yours", "Kind regards", "Warm regards", "Take care", "All the best", "Best wishes")
LONG_CLOSINGS = ("Thank you for consideration", "Thank you for your time", "Thank you for your help", "Thank you for everything", "Thank you for your time and attention")
GEORGIAN_CLOSINGS = ("პატივისცემით", "ძალიან მადლობა", "მადლობა")
# Marks that mail programs leave, and entities.
TECH_MARKS = (r"<x-apple-data-detectors://\d+>", r"<mailto:[^>]+>", r"\[EMAIL\]", r"\[LINK\]", r"\[PHONE\]")
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'))
# The shape of a university's signature.
COLLEGE = r"University \d{4} College of [A-Za-z]+ [A-Za-z]+"
PROPER_COLLEGE = r"[A-Z][a-z]+ University \d{4} College of [A-Z][a-z]+ [A-Z][a-z]+"

_EDIT_VARIANTS = tuple(p + dot for p in EDIT_PHRASES for dot in ("", r"\."))

#: Edit marks in brackets.
BRACKETED_EDITS = Chain(tuple(Rule(rf"\s*<{p}>\s*", " ", _I) for p in _EDIT_VARIANTS), ("edited",))
#: Edit marks with or without brackets, anywhere, inside words too.
ALL_EDITS = Chain(BRACKETED_EDITS.rules + tuple(Rule(rf"\s*{p}\s*", " ", _I) for p in _EDIT_VARIANTS), ("edited",))

_FAREWELLS = ("best,", "thanks,", "thank you,", "regards,", "sincerely,", "cheers,", "yours,", "care,", "wishes,", "consideration,", "time,", "help,", "everything,", "attention,")
_line = lambda p, need: Rule(rf"^\s*{p}\s*$", "", "mi", need)
# The order of quote lines, closings and signature lines.
QUOTES = Chain(
    tuple(_line(*p) for p in QUOTE_LINES)
    + tuple(_line(p + ",", f"{p.lower()},") for p in BARE_CLOSINGS)
    + (_line(r"--\s*[ა-ჰ]+", "--"), _line(r"--\s*[A-Za-z]+\s*[A-Za-z]*", "--"))
    + tuple(_line(rf"{p},\s*[A-Za-z]+", f"{p.lower()},") for p in CLOSINGS),
    ("wrote:", "from:", "sent from", "get outlook", "confidentiality caution", "intended", "epam.", "mobile:", "email:", "minsk,", "--", *_FAREWELLS),
)
MARKS = Chain(tuple(Rule(p, "", _I) for p in TECH_MARKS), ("<x-apple", "<mailto:", "[email]", "[link]", "[phone]"))
ENTITY_RULES = Chain(tuple(Rule(a, b) for a, b in ENTITIES), ("&",))
# Quote marks and run-together sentences within lines.
INLINE = Chain((Rule(r"^\s*>\s*", "", "m", ">"), Rule(r"On .+? wrote:", "", _I, "wrote:"), Rule(r"([,\.!?])([A-Za-z])", "{1} {2}")))
_end = lambda p, flags="", need="": Rule(rf"\s*{p}\s*\z", "", flags, need)
#: Characters that neither signatures (but for Georgian ones and a university's) nor mail tails (but for those in angle
#: brackets and one advertisement) hold.
_NOT_SIGNED, _NOT_TAIL = r".;:!?\"'()*%$&|=\[\]{}~^`", r".,;!?\"'()*%$&|=\[\]{}~^`"
# Signatures at a text's end, in order.
SIGNATURES = Chain(
    (Rule(rf"([A-Z][a-z]+ [A-Z][a-z]+ - [a-z]+\d+ {PROPER_COLLEGE})"), _end(r"--\s*[ა-ჰ]+\s*[ა-ჰ]*"), _end(r"--\s*[A-Za-z]+\s*[A-Za-z]*"), _end(r"[ა-ჰ]+\.[ა-ჰ]+"))
    + tuple(_end(rf"{p},\s*[A-Za-z]+", _I, f"{p.lower()},") for p in CLOSINGS)
    + tuple(_end(rf"{p},\s*[A-Za-z]+\s*[A-Za-z]*", _I, f"{p.lower()},") for p in LONG_CLOSINGS)
    + (_end(r"[A-Za-z]+ [A-Za-z]+ - \d+ - [a-z]+\d+"), _end(r"[A-Za-z]+ [A-Za-z]+ - [a-z]+\d+"), _end(r"[A-Za-z]+ [A-Za-z]+ - \d+"))
    + (_end(rf"[^\s]+ [A-Za-z]+ [A-Za-z]+ - [a-z]+\d+ [A-Za-z]+ {COLLEGE}"), _end(rf"[^\s]+ [A-Za-z]+ [A-Za-z]+ [A-Za-z]+ {COLLEGE}"))
    + (_end(rf"Thank you for your time and attention,\s*[A-Za-z]+ [A-Za-z]+ - [a-z]+\d+ [A-Za-z]+ {COLLEGE}", _I), _end(rf"Thank you for consideration,\s*[A-Za-z]+ [A-Za-z]+ [A-Za-z]+ {COLLEGE}", _I))
    + (_end(r"Sincerely\s*[A-Za-z]+ [A-Za-z]+", _I), _end(r"Sincerely,\s*[A-Za-z]+ [A-Za-z]+", _I))
    + (_end(r"Thank you again for your time,\s*[A-Za-z]+ [A-Za-z]+", _I), _end(rf"Thank you again for your time,\s*[A-Za-z]+ [A-Za-z]+ - [a-z]+\d+ [A-Za-z]+ {COLLEGE}", _I))
    + tuple(_end(rf"{p},\s*[ა-ჰ]+\s*[ა-ჰ]*") for p in GEORGIAN_CLOSINGS)
    + (_end(rf"[A-Z][a-z]+ [A-Z][a-z]+ - [a-z]+\d+ {PROPER_COLLEGE}"), _end(rf"[A-Z][a-z]+ [A-Z][a-z]+ {PROPER_COLLEGE}")),
    (" - ", "--", "university ", "sincerely", *_FAREWELLS, "მადლობა,", "პატივისცემით,"),
    r"[ა-ჰ]\.[ა-ჰ]",
    _NOT_SIGNED,
    r"(?iu)[ა-ჰ]|university",
)
# Placeholders of exported chats.
OMITTED_KINDS = r"image|video|audio|sticker|gif|document|contact(?:\s+card)?|location|photo|picture|file"
CHAT_PLACEHOLDERS = Chain(
    (Rule(r"\s*\[\d{1,2}/\d{1,2}/\d{2,4},\s*\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM)?\]\s*[^:]{1,100}:\s*[^\n]*?omitted\s*", "", _I), Rule(rf"\b(?:{OMITTED_KINDS})\s+omitted\b", "", _I)), ("omitted",)
)
# What mail leaves at the end of a body, in order; several of these take ordinary words along.
MAIL_TAILS = (
    _end(r"Sent from my (iPhone|iPad|Android|mobile device)", _I),
    _end(r"Get Outlook for (iOS|Android)", _I),
    _end(r">\s*>\s*>"),
    _end(r">\s*>"),
    _end(r"[A-Za-z]+\d+\s+[A-Za-z]+\s+University\s+\d{4}\s+College\s+of\s+[A-Za-z\s]+", _I),
    _end(r"[A-Z][a-z]+\s+[A-Z][a-z]+\s*-\s*[a-z]+\d+\s+[A-Z][a-z]+\s+University\s+\d{4}\s+College\s+of\s+[A-Za-z\s]+"),
    _end(r"----------\s*Forwarded message\s*----------", _I),
    _end(r">\s*[A-Za-z\s]+\s*>"),
    _end(r"[A-Z][a-z]+\s+[A-Z][a-z]+\s+University\s+\d{4}"),
    _end(r"GMT[+-]\d{2}:\d{2}\s*[A-Za-z\s]*", _I),
    _end(r"\d{1,2}:\d{2}\s*GMT[+-]\d{2}:\d{2}\s*[A-Za-z\s]*", _I),
    _end(r"Virus-free\.\s*www\.\s*avast\.com", _I),
    _end(r"Virus-free", _I),
    _end(r"<#[A-F0-9-]{36}>", _I),
    _end(r"[A-F0-9]{8}-[A-F0-9]{4}-[A-F0-9]{4}-[A-F0-9]{4}-[A-F0-9]{12}", _I),
    _end(r"<[^>]+@[^>]+>"),
    _end(r">\s*[^>]+\s*>"),
    _end(r">\s*[^>]+"),
    _end(r"\d{4}/\d{1,2}/\d{1,2}"),
    _end(r"[A-Za-z]+\s+Sales"),
    _end(r"--"),
    _end(r"<>"),
    _end(r":\d{1,2}\s*GMT[+-]\d{2}:\d{2}", _I),
    _end(r"GMT[+-]\d{2}:\d{2}", _I),
    _end(r"<"),
    _end(r"[A-Za-z]+\s+[A-Za-z]+\s*<"),
    _end(r"[A-Za-z]+\s+[A-Za-z]+\s*-"),
)
_TAIL_WHOLE = "(?iu)[<>]|avast"
# The last words of a mail that doesn't end in punctuation, and what goes after them.
LAST_WORDS = Rule(r"\s*[A-Za-z]+\s+[A-Za-z]+\s*[A-Za-z]*\s*\z")
_ENDS = (_end(r"\d{4}/\d{1,2}/\d{1,2}\s*[A-Za-z\s]*"), _end(r":\d{1,2}"))
#: All that is done at a mail's end, with and without its last words.
MAIL_END = Chain((*MAIL_TAILS, LAST_WORDS, *_ENDS), breaker=_NOT_TAIL, whole=_TAIL_WHOLE)
MAIL_END_MILD = Chain((*MAIL_TAILS, *_ENDS), breaker=_NOT_TAIL, whole=_TAIL_WHOLE)
