"""Phrases and patterns of the offline rule annotator.

Everything is matched against lower-cased English or Spanish text. Phrases are
plain substrings, which cost a fraction of a regex; words are phrases that must
stand alone. The few patterns left use only what Java regex and RE2 share.
"""

EDGE = r"(?:^|[^a-záéíóúüñ])"

# Marks that end a word; they become blanks where whole words are looked up.
MARKS = "\n\t.,;:!?¡¿()[]\"'/-…"

# Clauses that deny a finding, or that speak of a relative: dropped before the
# findings are looked up.
DENIED = EDGE + r"(?:no|not|sin|without|ningun[oa]?|ningún|nunca|never|denies|deny)[^a-záéíóúüñ.,;:!?][^.,;:!?\n]*|n't [^.,;:!?\n]*"
RELATIVES = [
    "mi madre", "mi padre", "mi hermano", "mi hermana", "mi abuelo", "mi abuela", "mi tío", "mi tía",
    "my mother", "my father", "my mom", "my dad", "my brother", "my sister", "my grandfather",
    "my grandmother", "my uncle", "my aunt",
]
RELATIVE = EDGE + "(?:" + "|".join(RELATIVES) + r")[^.;!?\n]*"

# Breathing trouble is often told with a "no", so the idioms are looked up in
# the text as it stands, the nouns in the text without denials.
DYSPNEA_IDIOMS = [
    "cuesta respirar", "no puedo respirar", "no respiro bien", "falta el aire", "falta de aire", "me ahogo",
    "el ahogo", "el aire no llega", "can't breathe", "cannot breathe", "hard to breathe", "trouble breathing",
    "difficulty breathing",
]
DYSPNEA_NOUNS = ["disnea", "dyspnea", "dyspnoea", "shortness of breath", "short of breath"]
FEVER = ["fiebre", "febril", "fever"]
FEVER_DEGREES = r"(?:3[89]|4[01])(?:[.,][0-9])? ?(?:grados|degrees|º|°)"
HIGH_FEVER_DEGREES = r"(?:39|4[01])(?:[.,][0-9])? ?(?:grados|degrees|º|°)"
DEGREE_ANCHORS = ["grados", "degrees", "º", "°"]
UNCONSCIOUS = [
    "pérdida de consciencia", "pérdida de conciencia", "perdí el conocimiento", "perdí el sentido",
    "perdí la consciencia", "perdí la conciencia", "me desmayé", "passed out", "lost consciousness",
    "loss of consciousness", "blacked out", "unconscious", "i fainted",
]
RADIATING = [
    "hasta el brazo", "al brazo", "brazo izquierdo", "mandíbula", "se irradia", "down my arm", "down my left arm",
    "to my arm", "to my left arm", "to my jaw", "radiates", "radiating", "spreads to", "spreading to",
]
CARDIAC_HISTORY = [
    "infarto", "angina", "enfermedad del corazón", "marcapasos", "arritmia", "insuficiencia cardíaca",
    "heart attack", "heart disease", "heart failure", "pacemaker", "arrhythmia", "cardiac history",
]
SMOKER_WORDS = [
    "fumo", "fumé", "fumaba", "fumador", "fumadora", "smoke", "smoker", "smoking", "smoked", "cigarrillos",
    "cigarettes", "pack a day", "packs a day", "pack per day",
]
CHEST_PAIN = ["chest pain", "chest pressure", "chest tightness", "pain in my chest", "dolor torácico"]
CHEST_PAIN_APART = r"dolor[^.,;!?\n]{0,30}(?:pecho|torácico)"
TACHYCARDIA = [
    "corazón acelerado", "corazón disparado", "palpitaciones", "palpitations", "heart racing", "heart is racing",
]

VITAL_THREAT = [
    "parada cardíaca", "parada cardiaca", "parada cardiorrespiratoria", "parada respiratoria", "cardiac arrest",
    "not breathing", "unresponsive",
]
ACUTE = [
    "ictus", "stroke", "slurred speech", "facial droop", "no puedo mover el brazo", "no puedo mover la pierna",
    "no puedo mover la cara", "can't move my arm", "can't move my leg", "can't move my face",
    "sepsis", "séptic", "septic", "hemorragia", "sangrado activo", "vomitando sangre", "heavy bleeding",
    "bleeding heavily", "vomiting blood", "coughing up blood", "fractura abierta", "open fracture",
]
LOW_SATURATION = r"satura(?:ción|tion)[^0-9\n]{0,20}[0-8][0-9](?:$|[^0-9])"
SATURATION_ANCHORS = ["saturación", "saturation"]
TRAUMA_WORDS = ["accidente", "accident", "traumatismo", "trauma", "me caí", "i fell", "car crash"]
SYMPTOM_WORDS = [
    "dolor", "duele", "molestia", "tos", "mareo", "vómitos", "diarrea", "inflamado", "inflamada", "hinchado",
    "hinchada", "pain", "hurts", "ache", "aching", "sore", "cough", "dizzy", "vomiting", "diarrhea", "swollen", "rash",
]

PANIC = [
    "me muero", "me voy a morir", "me estoy muriendo", "no puedo más", "i'm dying", "i am dying", "going to die",
    "panic attack", "pánico",
]
ANXIOUS = ["ansiedad", "angustia", "tengo mucho miedo", "anxiety", "anxious", "terrified", "so scared"]
WORRIED = ["preocupa", "me asusta", "nervios", "worried", "nervous", "scared", "muy mal"]

FEMALE_WORDS = ["female", "woman", "mujer"]
MALE_WORDS = ["male", "man", "hombre", "varón"]

# A number of years that is not an age.
NOT_AN_AGE = (
    r"(?:desde hace|hace|durante|for the last|for the past|for|last|past) "
    r"(?:como |casi |unos |about |almost )?[0-9a-záéíóúñ]+(?: y [a-záéíóúñ]+)? (?:años|years)"
)
YEAR_ANCHORS = ["años", "year"]
AGE_IN_YEARS = r"([0-9]{1,3})[ -]?(?:years?[ -]old|años)"
AGE_TOLD_ANCHORS = ["i'm ", "i am ", "age"]
AGE_TOLD = EDGE + r"(?:i'm|i am|aged|age is|age) ([0-9]{1,3})(?:$|[^0-9%/])"
NUMBER_WORDS = {
    "uno": 1, "un": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7,
    "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12, "trece": 13, "catorce": 14,
    "quince": 15, "dieciséis": 16, "diecisiete": 17, "dieciocho": 18, "diecinueve": 19,
    "veinte": 20, "veintiuno": 21, "veintiún": 21, "veintidós": 22, "veintitrés": 23,
    "veinticuatro": 24, "veinticinco": 25, "veintiséis": 26, "veintisiete": 27,
    "veintiocho": 28, "veintinueve": 29, "treinta": 30, "cuarenta": 40, "cincuenta": 50,
    "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90,
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7,
    "eight": 8, "nine": 9, "ten": 10,
}
_TENS = "treinta|cuarenta|cincuenta|sesenta|setenta|ochenta|noventa"
_UNITS = "uno|un|dos|tres|cuatro|cinco|seis|siete|ocho|nueve"
_LOW = "diez|once|doce|trece|catorce|quince|dieci[a-zé]+|veint[a-zéóú]+"
AGE_WORDS = EDGE + f"({_TENS}|{_LOW})(?: y ({_UNITS}))? años"

TEN_ANCHORS = ["10", "ten", "diez"]
PAIN_OF_TEN = r"([0-9]{1,2})(?: ?/ ?| out of | sobre )(?:10|ten|diez)(?:$|[^0-9])"
PAIN_ANCHORS = ["en un", "es un", "pain is", "pain of", "dolor de"]
PAIN_DIGITS = r"(?:en un|es un|pain is (?:a|an|about)?|pain of|dolor de) ?([0-9]{1,2})(?:$|[^0-9%/])"
PAIN_WORDS = (
    EDGE + r"(?:un|sobre un|maybe a|about a|an|a) (dos|tres|cuatro|cinco|seis|siete|ocho|nueve|diez"
    r"|two|three|four|five|six|seven|eight|nine|ten)(?:$|[,.!?]| quizás| out of)"
)

# What a patient answers to a question, on the line after the doctor's.
_ANSWER = r"[^\n]*\n+ *p: *([^\n]*)"
AGE_ASKED_ANCHORS = ["edad", "años", "how old", "your age"]
AGE_ASKED = r"(?:qué edad|su edad|cuántos años|how old|your age)" + _ANSWER
PAIN_ASKED_ANCHORS = ["a diez", "a 10", "al diez", "al 10", "to ten", "to 10"]
PAIN_ASKED = r"(?:(?:cero|uno|0|1) al? (?:diez|10)|(?:zero|one|0|1) to (?:ten|10))" + _ANSWER
ANSWERED_NUMBER = r"(?:^|[^0-9,.])([0-9]{1,3})(?:$|[^0-9%/])"
ANSWERED_WORDS = EDGE + f"({_TENS}|{_LOW}|{_UNITS}|one|two|three|four|five|six|seven|eight|nine|ten)(?: y ({_UNITS}))?(?:$|[^a-záéíóúüñ])"

# Where a finding is kept -> its normalised term, in the order of listing.
ENTITY_TERMS = {
    "_chest": "dolor torácico",
    "_dyspnea": "disnea",
    "_fever": "fiebre",
    "_unconscious": "pérdida de consciencia",
    "_radiating": "dolor irradiado",
    "_cardiac": "antecedente cardíaco",
    "_tachycardia": "taquicardia",
}
