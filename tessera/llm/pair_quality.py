"""Broken prompt-answer pairs: empty, copied, refused, truncated answers and answers in another language.

Two models are counted over whole tables and are small, of fixed size and safe to broadcast:

* a naive Bayes model of character n-grams by language, counted over labelled documents
  (``BUCKETS`` hashed n-grams per language, at most 26 * 26 languages);
* an end-of-text model: how often a character n-gram of the answers is the last one of its text
  without an end mark, of a list item, or a word's end elsewhere, counted over all answers.

The pairs themselves are then read once, without any shuffle.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import WORD, words
from tessera.session import spread

#: N-grams from which on a language has a class of its own, however rare it is among the documents.
BUCKETS, MIN_GRAMS = 1 << 16, 1_000
#: Buckets of the end-of-text model: many, as a rare tail must not share one with a frequent one.
END_BUCKETS = 1 << 22
#: Fewer words may be a name; a language is another by such a lead in log posterior, in all and per n-gram.
LANGUAGE_WORDS, LANGUAGE_ODDS, LANGUAGE_LEAD = 4, 12.0, 0.5
#: An end seen more rarely than this among its n-gram's occurrences is a break.
END_RATE, END_PRIOR = 0.02, 0.5
#: So is an unmarked prose end whose n-gram ends texts without a mark more often than so many times the
#: share of such ends among all prose ends (the share of an n-gram that only ends texts), or nearly always.
UNMARKED_LIFT, UNMARKED_MOST = 10, 0.9
#: Answers of at most so many words may be a name or a single word, and need no end mark.
SHORT = 3
#: Prompts whose language a task remembers.
CACHE = 50_000

# Placeholders of a missing answer, by their letters and digits.
PLACEHOLDERS = {
    "none", "null", "nil", "na", "nan", "undefined", "empty", "missing", "tbd", "todo", "blank", "noanswer", "nooutput", "noresponse",
    "noreply", "nocontent", "notavailable", "notapplicable", "answermissing", "noanswergiven", "noanswerprovided", "removed", "deleted",
    "keineantwort", "sinrespuesta", "pasderéponse", "aucuneréponse", "ninguna", "leer", "vacío", "vide", "response", "answer", "placeholder",
}

# What is missing, that it is missing, and words around it, in placeholders of any length.
MISSING_WHAT = set("answer answers response responses reply output content text result completion antwort inhalt ausgabe respuesta contenido salida réponse contenu sortie risposta contenuto resposta conteúdo".split())
MISSING_THAT = set("no not none missing without empty blank unavailable absent pending omitted removed deleted withheld fehlt fehlend fehlende keine kein nicht leer leere ohne entfernt sin falta faltante ninguna ningún vacía vacío eliminada pas aucune aucun manquante manquant vide sans supprimée nessuna mancante vuota senza nenhuma ausente vazia sem".split())
MISSING_AROUND = set("was were is are has have been be provided given available found recorded supplied returned generated received yet here for this the a an to in prompt question wurde ist angegeben vorhanden gegeben verfügbar die der das eine hier la el una un fue está disponible proporcionada dada aquí le une donnée fournie disponible ici de pour cette è stata fornita qui foi fornecida aqui".split())

# Openings of a refusal, in lower case with plain apostrophes.
REFUSAL = re.compile(
    r"as an? (?:ai|language|artificial|large)\b.{0,40}\b(?:not able|cannot|can't|unable|won't|not allowed|not permitted)\b"
    r"|(?:i'm|i am) sorry,? (?:but )?i (?:can't|cannot|can not|won't|am unable|am not able|must)"
    r"|sorry,? (?:that is|that's|but|i) .{0,24}\b(?:not|can't|cannot|won't|unable)\b"
    r"|i (?:can't|cannot|can not|won't|will not) (?:be able to )?(?:help|assist|answer|discuss|comment|provide|respond|support|do|fulfil|comply|talk)"
    r"|(?:i'm|i am) (?:unable|not able|not allowed|not permitted|not comfortable|not willing) to (?:provide|help|assist|answer|discuss|comment|respond|share|do)"
    r"|i have no (?:ability|permission|way|wish) to (?:respond|answer|help|comment|discuss)"
    r"|i(?:'d| would) (?:rather not|prefer not)\b|i prefer not to\b"
    r"|(?:unfortunately,? |regrettably,? )?i (?:must|have to|will have to) (?:decline|refuse)"
    r"|(?:unfortunately|regrettably),? (?:answering|i (?:can't|cannot|won't|am unable)|this is not|that is not|this isn't)"
    r"|i (?:decline|refuse) to\b|no comment\b"
    r"|(?:this|that|your) (?:request|question) (?:goes against|violates|is against|is not something|cannot be|can't be)"
    r"|(?:my|our) (?:policy|policies|guidelines|rules) (?:does|do|will)(?: not|n't)"
    r"|let's (?:talk|speak|chat) about something else|(?:can|could) we (?:talk|speak) about something else"
    r"|ich bin nicht (?:befugt|berechtigt|in der lage|autorisiert)|es ist mir (?:leider )?nicht (?:möglich|erlaubt|gestattet)|(?:das|dies|darüber|hierzu|dabei) (?:kann|darf|möchte|werde) ich .{0,40}nicht"
    r"|(?:к сожалению,? )?я не могу (?:помочь|ответить|обсуждать)|(?:抱歉|对不起|很遗憾).{0,20}(?:不能|无法)|我(?:不能|无法)(?:回答|帮助|讨论)"
    r"|als (?:ki|sprachmodell|künstliche)\b.{0,60}\b(?:nicht|kein)|(?:es )?tut mir (?:sehr )?leid,? (?:aber )?.{0,50}\bnicht"
    r"|leider (?:kann|darf|muss) ich|.{0,60}\b(?:darf|kann|möchte|werde) ich (?:leider )?nicht (?:beantworten|helfen|weiterhelfen|sprechen|äußern)"
    r"|dazu (?:möchte|kann|darf|werde) ich .{0,20}nicht|ich (?:kann|darf|möchte|werde) .{0,50}\bnicht (?:beantworten|helfen|äußern|dienen|weiterhelfen)"
    r"|como (?:modelo|ia|inteligencia)\b.{0,40}\bno (?:puedo|me)|lo (?:siento|lamento),? (?:pero )?no (?:puedo|es posible|me)|(?:no puedo|no me es posible) (?:ayudar|responder|contestar|hablar|comentar)"
    r"|no (?:me está|está) permitido|no (?:estoy|me siento) (?:autorizado|autorizada|cómodo|en condiciones)|no (?:voy a|podré|quiero|debo|deseo) (?:responder|contestar|hablar|ayudar|comentar)"
    r"|prefiero no\b|lamentablemente,? no\b|me temo que no\b|(?:esa|esta|su|tu) (?:solicitud|pregunta|petición) .{0,50}\bno (?:puedo|puede|está)"
    r"|en tant qu.{0,40}\bje ne (?:peux|suis|puis)|(?:je suis )?désolée?,? (?:mais )?(?:je ne|ce n)|je (?:préfère|préférerais) ne pas|je ne (?:peux|puis|suis) pas (?:en mesure|répondre|vous aider|t'aider|aider|traiter|commenter)"
    r"|je ne suis pas (?:autorisé|autorisée|habilité|habilitée|capable|en mesure)|il ne m'est pas (?:permis|possible)|je (?:ne veux|ne souhaite) pas (?:répondre|commenter|en parler)"
    r"|je (?:dois|me vois) .{0,20}(?:refuser|décliner)|malheureusement,? je ne|(?:cette|votre|ta) (?:demande|question) .{0,50}\bje ne (?:peux|puis)"
)
# Openings of sentences that may follow a refusal without being an answer.
COURTESY = re.compile(
    r"(?:thank|thanks|take care|please\b|you (?:may|can|could|might) (?:also )?(?:contact|ask|consult|try|reach|turn)|try (?:asking|another|rephras)|is there (?:anything|something)|feel free|let me know"
    r"|(?:maybe|perhaps) (?:someone|you|another|ask|try)|i hope you understand|have a (?:nice|good)|sorry|apologies|goodbye|good luck|best (?:wishes|regards)|contact|ask\b|consult"
    r"|bitte|danke|vielen dank|alles gute|kann ich sonst|versuchen sie|fragen sie|wenden sie|gracias|por favor|puede|pregunte|consulte|hay algo|intente|cuídese|merci|veuillez|vous pouvez|adressez|demandez|essayez|bonne|y a-t-il|puis-je)"
)
# Names of languages in the languages of the data, by code.
LANGUAGE_NAMES = {
    "en": "english englisch englische englischen englischer inglés inglesa anglais anglaise английский английском 英语 英文",
    "de": "german deutsch deutsche deutschen deutscher deutsches alemán alemana allemand allemande немецкий немецком 德语 德文",
    "es": "spanish spanisch spanische spanischen español española castellano espagnol espagnole испанский испанском 西班牙语",
    "fr": "french französisch französische französischen francés francesa français française французский французском 法语 法文",
    "ru": "russian russisch russische russischen ruso rusa russe русский русском 俄语 俄文",
    "zh": "chinese mandarin chinesisch chinesische chinesischen chino china chinois chinoise китайский китайском 中文 汉语 chinesich",
    "it": "italian italienisch italiano italiana italien italienne",
    "pt": "portuguese portugiesisch portugués portugais",
    "nl": "dutch niederländisch neerlandés holandés néerlandais",
    "pl": "polish polnisch polaco polonais",
}
_PLACEHOLDER_STARTS = {p for x in PLACEHOLDERS for p in (x[:n] for n in range(1, len(x) + 1))}
_NAMED = {name: code for code, names in LANGUAGE_NAMES.items() for name in names.split()}
WRAP = "\"'`´*_~()[]<>«»‹›“”„‚‘’ \t\r\n ​‌‍﻿　"
ITEM = re.compile(r"\s*(?:[-*•+–]|\d{1,3}[.)])\s+")
SENTENCE = re.compile(r"(?<=[.!?。！？…])[\s\"'”»)]+")
LETTERS = re.compile(r"[^\W\d_]+")
CODE = re.compile(r"```.*?(?:```|$)", re.S)
FINAL = ".!?。！？؟"
#: Marks after which a text goes on.
OPEN = ",;:-–—(/&+=…"


# ---- language model -----------------------------------------------------------------------------


def grams(text: str) -> np.ndarray:
    """Hashed character bigrams and trigrams of the lower-case text, letters only, words apart."""
    kept = " " + " ".join(WORD.findall(text.lower())) + " "
    c = np.frombuffer(kept.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    two = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint64(0x85EBCA6B) + c[2:] + np.uint64(7)
    h = np.concatenate([two, three])
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def language_code(col):
    """Two letters of a language tag; null where it isn't one."""
    tag = F.lower(F.trim(col))
    return F.when(tag.rlike(r"^[a-z]{2}([-_].*)?$"), F.substring(tag, 1, 2))


def language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [bucket, language]) counted over all labelled documents; the last
    row has the log priors, the languages' shares of all n-grams."""
    tagged = docs.select(language_code(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # At most 26 * 26 codes exist.
    langs = sorted(r.lang for r in tagged.select("lang").distinct().collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts = {k: i for i, k in enumerate(langs)}, {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                made = np.bincount(grams(text), minlength=BUCKETS)
                if lang in counts:
                    counts[lang] += made
                else:
                    counts[lang] = made
        for lang, n in counts.items():
            j = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(j + at[lang] * BUCKETS), pa.array(n[j])], ["at", "n"])

    rows = spread(tagged).mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(langs) * BUCKETS)
    counts[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    counts = counts.reshape(len(langs), BUCKETS)
    enough = counts.sum(axis=1) >= MIN_GRAMS
    langs, counts = [x for x, ok in zip(langs, enough, strict=True) if ok], counts[enough] + 0.1
    of = counts.sum(axis=1, keepdims=True)
    return langs, np.log(np.concatenate([counts / of, of / of.sum()], axis=1)).T.astype(np.float32).copy()


def posteriors(text: str, table: np.ndarray) -> tuple[np.ndarray, int]:
    """Log posterior odds of every language up to a common term, and the number of n-grams."""
    g = grams(text)
    return table[g].sum(axis=0) + table[-1], len(g)


def language_of(text: str, langs: list[str], table: np.ndarray) -> tuple[str | None, float]:
    """The likeliest language and its lead in log posterior per n-gram over the second."""
    if len(langs) < 2:
        return None, 0.0
    score, n = posteriors(text, table)
    if not n:
        return None, 0.0
    order = np.argsort(score)
    return langs[order[-1]], float(score[order[-1]] - score[order[-2]]) / n


# ---- end-of-text model --------------------------------------------------------------------------


def is_item(line: str, stopped: bool) -> bool:
    """A list item of at most eight words, in a list whose items carry no full stops."""
    return not stopped and bool(ITEM.match(line)) and len(line.split()) <= 9


def body_of(text: str) -> tuple[str, str]:
    """(kind, text without wrapping marks and emoji at its end); kind is ``item`` if it ends with a
    list item without a full stop, as are the items before it, else ``text``."""
    s = text.strip(WRAP)
    while s and (ord(s[-1]) >= 0x1F000 or s[-1] in "\ufe0f☺♥✓★"):
        s = s[:-1].rstrip(WRAP)
    *before, last = s.split("\n")
    stopped = any(x.rstrip().endswith(tuple(FINAL)) for x in before if ITEM.match(x))
    return ("item" if is_item(last, stopped) else "text"), s


def tail_gram(kind: str, s: str) -> int:
    """Bucket of the last three characters (digits alike), and for a list item its number of words."""
    t = re.sub(r"\d", "0", s[-3:].lower())
    salt = f"{kind}{min(9, len(s.rsplit(chr(10), 1)[-1].split()))}" if kind == "item" else "text"
    h = 2166136261
    for ch in salt + "|" + t:
        h = ((h ^ ord(ch)) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & (END_BUCKETS - 1)


def is_object(answer: str) -> bool:
    return answer.strip(" \t\r\n\ufeff\u200b\"'`").startswith(("{", "[{", "[\""))


def end_model(answers: list[DataFrame]) -> np.ndarray:
    """Rate at which a tail is the end of its text or list item, by bucket, over all answers.

    Inside a list item every word's end is an occurrence that isn't an end.  Of prose only the ends
    without a mark count as ends, once for all copies of a text and less the judged one, so that none
    vouches for itself; every other word's end, also before a mark, is an occurrence.  A tail that is
    hardly ever a word's end but there has rate 0: the word itself breaks off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, alls = np.zeros(END_BUCKETS, np.int32), np.zeros(END_BUCKETS, np.int32)
        cache: dict[tuple[str, int, str], int] = {}
        found, open_at, open_key, unmarked, prose = Counter(), [], [], 0, 0

        def bucket(kind: str, n: int, tail: str) -> int:
            key = (kind, n, tail)
            b = cache.get(key)
            if b is None:
                if len(cache) > 300_000:
                    cache.clear()
                b = cache[key] = tail_gram(kind, "x " * (n - 1) + tail if kind == "item" else tail)
            return b

        def flush() -> None:
            for t, k in found.items():
                alls[tail_gram("text", t)] += k
            found.clear()

        tails, marked_tails = re.compile(r"\S{1,3}(?=\s|$)"), re.compile(r"[^\W_]{1,3}(?=[^\w\s]+(?:\s|$))")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or is_object(text):
                    continue
                kind, s = body_of(CODE.sub("", text))
                if not s:
                    continue
                # An answer that ends with code has no prose end.
                whole = text.rstrip().endswith("```") or text.count("```") % 2 or (s[-1] in FINAL and not s.endswith("..."))
                lines, stopped = s.split("\n"), False
                for k, line in enumerate(lines):
                    last = k == len(lines) - 1
                    if ITEM.match(line) and line.rstrip().endswith(tuple(FINAL)):
                        stopped = True
                    if is_item(line, stopped):
                        parts = line.split()
                        for n in range(2, len(parts) + 1):
                            b = bucket("item", n, re.sub(r"\d", "0", parts[n - 1][-3:].lower()))
                            alls[b] += 1
                            if n == len(parts):
                                ends[b] += 1
                        continue
                    low, end = line.lower(), ""
                    if last and not whole:
                        end = s.split()[-1][-3:]
                        low = low[: len(low) - len(low.split()[-1])]
                    found.update(tails.findall(low))
                    found.update(marked_tails.findall(low))
                    if last and len(s.split()) > SHORT:
                        prose += 1
                        if end and s[-1] not in OPEN and not s.endswith("..."):
                            unmarked += 1
                            open_at.append(bucket("text", 0, end))
                            open_key.append(int.from_bytes(blake2b(" ".join(words(text)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
                if len(found) > 300_000:
                    flush()
            if open_at:
                none = [0] * len(open_at)
                yield pa.RecordBatch.from_arrays([pa.array(open_at, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(open_key, pa.int64())], names)
                open_at, open_key = [], []
        flush()
        at = np.flatnonzero(alls)
        # The number of prose ends, and of those without a mark, under -1.
        cols = [np.append(at, -1), np.append(ends[at].astype(np.int64), unmarked), np.append(alls[at].astype(np.int64), prose)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.nulls(len(at) + 1, pa.int64())], names)

    names, source = ["at", "e", "n", "key"], None
    for df in answers:
        for c in df.columns:
            part = df.select(F.col(c).alias("text"))
            source = part if source is None else source.unionByName(part)
    made = spread(source).mapInArrow(run, "at bigint, e bigint, n bigint, key bigint")
    # Copies of a text count once.
    rows = made.groupBy("at", "key").agg(F.sum("e").alias("e"), F.sum("n").alias("n"))
    rows = rows.groupBy("at").agg(F.sum("e").alias("e"), F.sum("n").alias("n"), F.count("key").alias("open")).toArrow()
    at, e, n, unmarked = (rows.column(c).to_numpy() for c in ("at", "e", "n", "open"))
    total, tail = at < 0, at >= 0
    share = e[total].sum() / max(1, n[total].sum())
    at, e, n, unmarked = at[tail], e[tail], n[tail], unmarked[tail]
    other = np.maximum(unmarked - 1, 0)
    found = (e + other + END_PRIOR * END_RATE) / (n + other + END_PRIOR)
    found[unmarked > min(UNMARKED_LIFT * share, UNMARKED_MOST) * (unmarked + n)] = 0
    rate = np.full(END_BUCKETS, END_RATE, np.float32)
    rate[at] = found
    return rate


# ---- the tests ----------------------------------------------------------------------------------


def is_empty(answer: str | None, found: list[str]) -> bool:
    """Null, or nothing but blanks, marks or a placeholder: ``found`` are the answer's words."""
    if answer is None or not found:
        return True
    first = found[0]
    if first not in _PLACEHOLDER_STARTS and first not in MISSING_WHAT and first not in MISSING_THAT and first not in MISSING_AROUND:
        return False
    plain = "".join(found)
    if plain in PLACEHOLDERS:
        return plain not in ("response", "answer", "na") or not answer.strip().isalpha()
    mine = set(found)
    return bool(mine & MISSING_WHAT) and bool(mine & MISSING_THAT) and mine <= MISSING_WHAT | MISSING_THAT | MISSING_AROUND


def is_copied(prompt_words: list[str], answer: str, w: list[str]) -> bool:
    """Nothing but the prompt's words from its first on, after an introduction of at most four words
    that ends in a colon, or repeated; the last word may be cut off."""
    p = prompt_words
    if len(w) < 3 or not p:
        return False

    def copies(rest: list[str]) -> bool:
        if len(rest) < min(4, len(p)) or (len(rest) < 4 and len(rest) < len(p)):
            return False
        at, n = 0, len(p)
        while at < len(rest):
            part = rest[at : at + n]
            if part[:-1] != p[: len(part) - 1]:
                return False
            if part[-1] != p[len(part) - 1] and not (at + len(part) == len(rest) and p[len(part) - 1].startswith(part[-1])):
                return False
            at += n
        return True

    if copies(w):
        return True
    head, colon, tail = answer.partition(":")
    if not colon:
        return False
    n = len(WORD.findall(head))
    return bool(colon) and 1 <= n <= 4 and len(w) > n and copies(w[n:])


def is_refusal(answer: str) -> bool:
    """A refusal and nothing but courtesies before and after it, however long."""
    s, refused = answer.lower().replace("’", "'").replace("‘", "'").strip(WRAP), False
    at = 0
    while at < len(s):
        m = SENTENCE.search(s, at)
        part = " ".join(s[at : m.start() if m else len(s)].split()).strip(WRAP)
        at = m.end() if m else len(s)
        if not WORD.search(part):
            continue
        if REFUSAL.match(part):
            refused = True
        elif not COURTESY.match(part) and (refused or part.count(" ") > 1):
            return False
    return refused


def is_truncated(answer: str, prompt_words: list[str], rate: np.ndarray) -> bool:
    """Breaks off: an open code block or object, a final comma or ellipsis, or an end that hardly
    ever is one."""
    s = answer.strip()
    if s.count("```") % 2:
        return True
    kind, s = body_of(s)
    if not s:
        return False
    if s.endswith("```") or answer.rstrip(WRAP + FINAL).endswith("```") or answer.rstrip().endswith("```"):
        return False
    if is_object(answer):
        inner = answer.strip(" \t\r\n﻿​'`")
        try:
            json.loads(inner)
            return False
        except ValueError:
            return inner.count("{") + inner.count("[") != inner.count("}") + inner.count("]")
    bare = answer.rstrip().rstrip("\"'`”»)]")
    if bare.endswith(("…", "...")) or s.endswith(("…", " ...")):
        return len(WORD.findall(s)) > SHORT
    n = len(s.split())
    if s[-1] in ",;:-–—(" or (n > SHORT and s[-1] in "/&+="):
        return n > 1
    if s[-1] in FINAL:
        return False
    if kind == "item":
        tail = words(s.rsplit("\n", 1)[-1])
        if tail:
            # A name cut off: no word of its own anywhere else, but the start of one.
            others = set(words(s.rsplit("\n", 1)[0])) | set(prompt_words) | set(tail[:-1])
            if tail[-1] not in others and any(x.startswith(tail[-1]) for x in others):
                return True
        return rate[tail_gram("item", s)] < END_RATE
    if n <= SHORT:
        return False
    last = s.split()[-1][-3:]
    return rate[tail_gram("text", last)] < END_RATE


def is_other_language(answer: str, prompt: str, prompt_words: set[str], prompt_lang: tuple[str | None, float], langs: list[str], table: np.ndarray) -> bool:
    """Written in another language than the prompt, which doesn't name that language: by the posterior
    odds of the two languages, of the answer's words that aren't the prompt's.  Up to three words may
    be a name, which is a sound answer in any language."""
    if prompt_lang[0] is None or prompt_lang[1] < LANGUAGE_LEAD / 4:
        return False
    plain = CODE.sub(" ", answer) if "```" in answer else answer
    own = [w for w in LETTERS.findall(plain.lower()) if w not in prompt_words]
    if len(own) < LANGUAGE_WORDS and not any(ord(c) > 0x2E80 for w in own for c in w):
        return False
    score, n = posteriors(" ".join(own), table)
    best = int(np.argmax(score))
    lang = langs[best]
    if lang == prompt_lang[0] or score[best] - score[langs.index(prompt_lang[0])] < max(LANGUAGE_ODDS, LANGUAGE_LEAD * n):
        return False
    low = prompt.lower()
    asked = {_NAMED[w] for w in prompt_words if w in _NAMED} | {c for n, c in _NAMED.items() if ord(n[0]) > 0x2E80 and n in low}
    return lang not in asked


def find_defects(df: DataFrame, row_col: str, prompt_col: str, answer_cols: list[str], table: str, langs: list[str], language, ends) -> DataFrame:
    """(record_table, row_index, field, defect): one row for each defective answer.

    ``language`` and ``ends`` are broadcasts of the two models.  A null prompt is an empty one: its
    answers can't be copied or in another language.  Repeated rows count each, an empty table gives
    nothing, other columns are not looked at, texts are examined whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, rate = language.value, ends.value
        spoken: dict[str, tuple[str | None, float]] = {}
        for batch in batches:
            rows, fields, defects = [], [], []
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row, prompt, *answers in zip(*cols, strict=True):
                prompt = prompt or ""
                pw = words(prompt)
                pl = known = None
                for name, a in zip(answer_cols, answers, strict=True):
                    aw = words(a)
                    if is_empty(a, aw):
                        d = "empty"
                    elif is_copied(pw, a, aw):
                        d = "copied"
                    elif is_refusal(a):
                        d = "refusal"
                    else:
                        if pl is None:
                            pl, known = spoken.get(prompt), set(pw)
                            if pl is None:
                                if len(spoken) >= CACHE:
                                    spoken.clear()
                                pl = spoken[prompt] = language_of(prompt, langs, lm)
                        d = None
                        if is_other_language(a, prompt, known, pl, langs, lm):
                            d = "language"
                        elif is_truncated(a, pw, rate):
                            d = "truncated"
                    if d:
                        rows.append(row)
                        fields.append(name)
                        defects.append(d)
            yield pa.RecordBatch.from_arrays([pa.array([table] * len(rows), pa.string()), pa.array(rows, pa.int64()), pa.array(fields, pa.string()), pa.array(defects, pa.string())], ["record_table", "row_index", "field", "defect"])

    source = df.select(F.col(row_col).cast("bigint"), F.col(prompt_col), *(F.col(c) for c in answer_cols))
    return spread(source).mapInArrow(run, "record_table string, row_index bigint, field string, defect string")


def pair_defects(spark: SparkSession, tables: dict[str, tuple[DataFrame, str, str, list[str]]], docs: DataFrame) -> DataFrame:
    """Defects of several tables {name: (df, row column, prompt column, answer columns)}, with the
    language model of ``docs`` (text, lang) and the end model of all answers."""
    langs, table = language_model(docs)
    rate = end_model([df.select(*answers) for df, _, _, answers in tables.values()])
    language, ends = spark.sparkContext.broadcast(table), spark.sparkContext.broadcast(rate)
    out = None
    for name, (df, row, prompt, answers) in tables.items():
        part = find_defects(df, row, prompt, answers, name, langs, language, ends)
        out = part if out is None else out.unionByName(part)
    return out
