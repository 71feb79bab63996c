"""Word lists and patterns that results depend on."""

#: The public Swedish stop-word list of 114 words.
SWEDISH_STOP_WORDS = """
och det att i en jag hon som han på den med var sig för så till är men ett om hade de av icke mig du henne då sin nu har inte hans honom
skulle hennes där min man ej vid kunde något från ut när efter upp vi dem vara vad över än dig kan sina här ha mot alla under någon eller
allt mycket sedan ju denna själv detta åt utan varit hur ingen mitt ni bli blev oss din dessa några deras blir mina samma vilken er sådan
vår blivit dess inom mellan sådant varför varje vilka ditt vem vilket sitta sådana vart dina vars vårt våra ert era vilkas
""".split()

#: Frequent words by language, for the language vote.
LANGUAGE_WORDS = {
    "sv": "och att det som en ett på är av för med till den inte om så jag hon när från har vid men eller han de vi",
    "en": "the of and to in is that it was for on are as with they be at this have from or by not but what we",
    "no": "og å det som en et på er av for med til ikke jeg hun når fra har ved men eller han de vi så",
    "de": "und der die das ist in zu den nicht von mit dem auf eine für sich des im ein wir sie er aber bei nach",
    "fi": "ja on ei se että oli kun mutta hän joka ovat koska vaikka myös niin kuin jälkeen ennen ne sen",
    "fr": "le la les de des et un une est dans que qui pour pas sur avec il elle nous du au après mais par en",
}

DISCUSSION_WORDS = "forum thread tråd diskussion viewtopic showthread vbulletin phpbb".split()
ARTICLE_WORDS = "artikel nyheter article news pressmeddelande blogg nyhet".split()

#: Addresses with these ends are no HTML pages.
OTHER_FILES = "pdf jpg jpeg png gif svg mp4 mp3 zip gz txt".split()

#: Lines of fewer than five words with one of these are navigation.
SHORT_LINE_WORDS = """
main page members videos photos blog posts add view contact home about us services gallery forum login sign up register search menu
navigation sidebar posted by on comment comments read more share tweet download click here submit next previous close
köp lager kr sek omdömen epub pdf tag category expand cart zoom edit logga meny sök hem cookies dela
""".split()

STREET_SUFFIXES = "vägen gatan gata gränden stigen torget torg backen allén leden platsen plan kroken svängen väg stig".split()
PRICE_UNITS = "kr sek :- st år m² cm mm kg".split()
BULLETS = "ᐈ•»«▪■●★☆"

#: Drop if a share is above: duplicate lines and paragraphs, their characters, top 2- to 4-grams, duplicate 5- to 10-grams.
REPETITION_LIMITS = {
    "dup_line_share": 0.30, "dup_paragraph_share": 0.30, "dup_line_chars": 0.20, "dup_paragraph_chars": 0.20,
    "top_2": 0.20, "top_3": 0.18, "top_4": 0.16, "dup_5": 0.15, "dup_6": 0.14, "dup_7": 0.13, "dup_8": 0.12, "dup_9": 0.11, "dup_10": 0.10,
}

#: White space as Python splits it; the same class works in Java's and RE2's regular expressions.
WS = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}])"
FOREIGN = r"[\x{4e00}-\x{9fff}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{0400}-\x{04ff}\x{0370}-\x{03ff}\x{0590}-\x{05ff}]"

#: Contact data (fixed values). A phone number may follow any character that is no word character.
EMAIL = r"(?i)\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b"
PHONE = r"(?U)(?<!\w)(?:\+46\s?|0)[1-9](?:[\s-]?\d){6,11}\d\b"
#: The same where a plus sign needs a word character before it, as in the pipeline that this engine replaces.
PHONE_PARITY = r"(?U)\b(?:\+46\s?|0)[1-9](?:[\s-]?\d){6,11}\d\b"
POSTCODE = rf"(?U)(?i)\b[1-9]\d{{2}}\s?\d{{2}}\b(?!\s*(?:{'|'.join(PRICE_UNITS)}))"
ADDRESS = rf"(?U)(?i)\b(?:\w+\s+){{0,2}}\w+(?:{'|'.join(STREET_SUFFIXES)})(?:\s+\d+[a-zA-Z]?)?\b"

#: Selectors of page parts (fixed values): classes and ids by exact value, and parts of them.
WIDGET_CLASSES = "gsc-search-box widget Stats Stats1_content Image".split()
COMMENT_IDS = "comments disqus_thread guestbook".split()
COMMENT_CLASSES = "comments disqus comment-body comment-content commentlist guestbook".split()
NOISE_PARTS = "cookie menu".split()
NOISE_CLASS_PARTS = "share social sidebar banner footer header".split()
NOISE_TAGS = "script style nav footer header table button form select input aside iframe noscript label caption".split()
LAYOUT_WORDS = "search gsc-search menu nav sidebar widget stats".split()
