"""Instruction records: checks, repair, conversion, responses and references, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .classify import has_letters, verdict_type
from .text import SPACE, hash16, strip

VERDICT = rf"(?i)VERDICT:{SPACE}*(True|False|correct|incorrect)"
#: Templates and labels that records carry (fixed values).
JUDGE_EN = ("Based on the following context, determine if this claim is correct or incorrect and explain why:\n\nContext: ", "\n\nClaim: ")
JUDGE_AR = ("بناءً على السياق التالي، حدد ما إذا كان هذا الادعاء صحيحًا أم خاطئًا وأوضح السبب:\n\nالسياق: ", "\n\nالادعاء: ")
VERIFY = "Verify the following analysis against AAOIFI standards."
WRONG_EN = "This claim is incorrect according to AAOIFI standards."
WRONG_AR = "هذا الادعاء غير صحيح وفقاً للمعايير الشرعية المحاسبية."
REFERENCES_EN = [r"Standard\s+No\.\s*(\d+)", r"AAOIFI\s+Standard\s+(\d+)", r"Section\s+(\d+)", r"Paragraph\s+(\d+)", r"FAS\s+(\d+)", r"GSIFI\s+(\d+)"]
REFERENCES_AR = [r"معيار\s+رقم\s+(\d+)", r"المعيار\s+(\d+)", r"الفقرة\s+(\d+)", r"البند\s+(\d+)"]
LABEL_EN, LABEL_AR = "AAOIFI Standard ", "معيار رقم "
NEGATE_EN = [("permissible", "not permissible"), ("allowed", "not allowed"), ("correct", "incorrect")]
NEGATE_AR = [("يجوز", "لا يجوز"), ("مسموح", "غير مسموح"), ("صحيح", "خاطئ")]
NEGATE_ELSE_EN, NEGATE_ELSE_AR = "It is not correct that ", "ليس من الصحيح أن "


def missing_fields(raw: Column, fields: tuple[str, ...] = ("instruction", "input", "output")) -> Column:
    """Array of the fields that the raw JSON object lacks; a null value counts as present."""
    return F.array_except(F.array(*[F.lit(f) for f in fields]), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))


def issues_audit(output: Column) -> Column:
    """Array of what the output lacks: verdict, explanation, reference."""
    return F.array_compact(
        F.array(
            F.when(~output.rlike(VERDICT), "No valid VERDICT in output"),
            F.when(~output.contains("xplanation:") & ~output.contains("xplain"), "No explanation in output"),
            F.when(~output.contains("eference:"), "No reference in output"),
        )
    )


def issues_validate(output: Column) -> Column:
    """The same by labelled parts, in either language and case."""
    return F.array_compact(
        F.array(
            F.when(~output.rlike(VERDICT), "Invalid or missing VERDICT"),
            F.when(~output.rlike("(?i)(Explanation|تفسير|توضيح):"), "Missing explanation"),
            F.when(~output.rlike("(?i)(Reference|مرجع):"), "Missing reference"),
        )
    )


def is_filled(*parts: Column, least: int = 10) -> Column:
    """All parts are there and have so many characters without white space at their ends."""
    out = F.lit(True)
    for p in parts:
        out = out & F.coalesce(F.char_length(strip(p)) >= least, F.lit(False))
    return out


def alpaca_verdict(output: Column) -> Column:
    """Whether an output states its verdict in the exact form."""
    return output.rlike(rf"VERDICT:{SPACE}*(True|False)")


def judge_instruction(context: Column, claim: Column, arabic: Column) -> Column:
    make = lambda t: F.concat(F.lit(t[0]), context, F.lit(t[1]), claim)
    return F.when(arabic, make(JUDGE_AR)).otherwise(make(JUDGE_EN))


def verdict_output(verdict: Column, explanation: Column, reference: Column) -> Column:
    return F.concat(F.lit("VERDICT: "), verdict, F.lit("\nExplanation: "), explanation, F.lit("\nReference: "), reference)


def alpaca_from_judgment(kind: Column, claim: Column, context: Column, explanation: Column, reference: Column, language: Column) -> Column:
    """Struct instruction, input, output of a raw judgment; missing fields are empty, a missing reference UNKNOWN."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        judge_instruction(empty(context), empty(claim), F.coalesce(language, F.lit("english")) == "arabic").alias("instruction"),
        F.lit("").alias("input"),
        verdict_output(verdict_type(empty(kind)), empty(explanation), F.coalesce(reference, F.lit("UNKNOWN"))).alias("output"),
    )


def alpaca_from_qa(question: Column, answer: Column) -> Column:
    return F.struct(F.coalesce(question, F.lit("")).alias("instruction"), F.lit("").alias("input"), F.coalesce(answer, F.lit("")).alias("output"))


def claim_of(text: Column, label: str = "Claim:") -> Column:
    """What follows the first label up to the line's end, stripped; empty without a label."""
    rest = F.substr(text, F.instr(text, F.lit(label)) + len(label))
    return F.when(F.instr(text, F.lit(label)) > 0, strip(F.substring_index(rest, "\n", 1))).otherwise(F.lit(""))


def claim_preview(instruction: Column) -> Column:
    """100 characters from the claim's label, or from the start, in one line, and three points."""
    at = F.when(F.instr(instruction, F.lit("Claim:")) > 0, F.instr(instruction, F.lit("Claim:"))).when(F.instr(instruction, F.lit("الادعاء:")) > 0, F.instr(instruction, F.lit("الادعاء:"))).otherwise(1)
    return F.replace(F.concat(F.substr(instruction, at, F.lit(100)), F.lit("...")), F.lit("\n"), F.lit(" "))


def repair_output(output: Column) -> Column:
    """Adds a verdict, an explanation and a reference where they lack.

    As the reference form demands: an output that says correct (or incorrect) anywhere gets True;
    without `xplanation:` all behind the verdict's line becomes the explanation, and UNKNOWN the reference.
    """
    verdict = F.when(F.lower(output).contains("correct"), "True").otherwise("False")
    output = F.when(output.rlike(VERDICT), output).otherwise(F.concat(F.lit("VERDICT: "), verdict, F.lit("\n"), output))
    behind = F.substr(output, F.instr(output, F.lit("VERDICT:")) + 8)
    first = F.substring_index(behind, "\n", 1)
    rest = F.when(behind.contains("\n"), F.substr(behind, F.char_length(first) + 2)).otherwise(F.lit(""))
    whole = F.concat(F.lit("VERDICT:"), first, F.lit("\nExplanation: "), rest, F.lit("\nReference: UNKNOWN"))
    output = F.when(~output.contains("xplanation:") & output.contains("VERDICT:"), whole).otherwise(output)
    return F.when(output.contains("eference:"), output).otherwise(F.concat(output, F.lit("\nReference: UNKNOWN")))


def strip_fence(text: Column, strict: bool = False) -> Column:
    """A fenced response without its fence: 7 or 3 characters at the start, and the last 3.

    The last 3 go unchecked, so an unclosed response loses text; strict takes them only if they are a fence.
    """
    text = strip(text)
    end = F.when(text.endswith("```"), 3).otherwise(0) if strict else F.lit(3)
    cut = lambda k: F.substr(text, F.lit(k + 1), F.greatest(F.char_length(text) - k - end, F.lit(0)))
    return F.when(text.startswith("```json"), cut(7)).when(text.startswith("```"), cut(3)).otherwise(text)


def parse_response(text: Column) -> Column:
    """Struct verdict, explanation, reference (UNKNOWN if missing) of a response; null if it is no JSON or lacks one of the first two."""
    got = F.from_json(strip_fence(text), "verdict string, explanation string, reference string")
    ok = got["verdict"].isNotNull() & got["explanation"].isNotNull()
    return F.when(ok, F.struct(got["verdict"].alias("verdict"), got["explanation"].alias("explanation"), F.coalesce(got["reference"], F.lit("UNKNOWN")).alias("reference")))


def parse_qa(text: Column) -> Column:
    """Array of structs question, answer of an object with `qa_pairs`; null if it isn't one."""
    return F.from_json(text, "qa_pairs array<struct<question: string, answer: string>>")["qa_pairs"]


def final_from_response(claim: Column, context: Column, response: Column, reference: Column) -> Column:
    return F.struct(
        F.lit(VERIFY).alias("instruction"),
        F.concat(F.lit("Claim: "), claim, F.lit("\nContext: "), context).alias("input"),
        verdict_output(response["verdict"], response["explanation"], reference).alias("output"),
    )


def final_from_example(kind: Column, claim: Column, context: Column, explanation: Column, reference: Column, seed_claim: Column) -> Column:
    """Record of a generated example: an UNKNOWN reference is shown as Context; prompt_hash is of the seed."""
    verdict = verdict_type(F.coalesce(kind, F.lit("")))
    ref = F.coalesce(reference, F.lit(""))
    return F.struct(
        F.lit(VERIFY).alias("instruction"),
        F.concat(F.lit("Claim: "), F.coalesce(claim, seed_claim), F.lit("\nContext: "), context).alias("input"),
        verdict_output(verdict, F.coalesce(explanation, F.lit("")), F.when(ref == "UNKNOWN", F.lit("Context")).otherwise(ref)).alias("output"),
        hash16(seed_claim, context).alias("prompt_hash"),
        ((ref == "UNKNOWN") | ((verdict == "True") & (ref == ""))).alias("suspected_fabrication"),
    )


def _unicode(pattern: str) -> str:
    return f"(?iU){pattern}"


def extract_references(text: Column, arabic: bool = False, patterns: list[str] | None = None, label: str | None = None) -> Column:
    """Array of canonical references, all of one pattern before those of the next.

    The own patterns all take a number behind white space or a point; texts without one aren't searched.
    """
    label = label if label is not None else (LABEL_AR if arabic else LABEL_EN)
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(_unicode(p)), 1) for p in patterns or (REFERENCES_AR if arabic else REFERENCES_EN)]))
    if patterns is None:
        found = F.when(text.rlike(r"(?U)[.\s]\d"), found).when(text.isNotNull(), F.array().cast("array<string>"))
    return F.transform(found, lambda n: F.concat(F.lit(label), n))


def first_reference(context: Column, letters: str | None = None) -> Column:
    """The first reference that the context names, by the language of its letters; null if there is none."""
    arabic = has_letters(context, letters) if letters else has_letters(context)
    return F.when(arabic, F.get(extract_references(context, True), F.lit(0))).otherwise(F.get(extract_references(context, False), F.lit(0)))


def fix_reference(reference: Column, in_corpus: Column, context: Column) -> Column:
    """UNKNOWN and references of the corpus stay; others become the context's first, or UNKNOWN. An empty one is in any corpus."""
    return F.when((reference == "UNKNOWN") | in_corpus, reference).otherwise(F.coalesce(first_reference(context), F.lit("UNKNOWN")))


def context_of(instruction: Column) -> Column:
    """The context between its label and the claim's, in either language; null without labels."""
    got = F.regexp_extract(instruction, rf"(?s)(?:السياق:{SPACE}*(.+?)\n\nالادعاء:|Context:{SPACE}*(.+?)\n\nClaim:)", 0)
    ar = F.regexp_extract(got, rf"(?s)^السياق:{SPACE}*(.+?)\n\nالادعاء:", 1)
    en = F.regexp_extract(got, rf"(?s)^Context:{SPACE}*(.+?)\n\nClaim:", 1)
    return F.when(got == "", F.lit(None)).otherwise(F.when(ar != "", ar).otherwise(en))


def reference_of(output: Column) -> Column:
    """The first stated reference, stripped; UNKNOWN without one."""
    got = strip(F.regexp_extract(output, rf"Reference:{SPACE}*([^\n]+)", 1))
    return F.when(output.rlike(rf"Reference:{SPACE}*[^\n]"), got).otherwise(F.lit("UNKNOWN"))


def rewrite_reference(output: Column, reference: Column) -> Column:
    """Every stated reference replaced; signs of the new one are taken as they are."""
    quoted = F.regexp_replace(reference, r"([\\$])", r"\\$1")
    return F.regexp_replace(output, F.lit(rf"Reference:{SPACE}*[^\n]+"), F.concat(F.lit("Reference: "), quoted))


def downgrade_reference(reference: Column, verified: Column) -> Column:
    """Struct reference, suspected: an unverified reference becomes UNKNOWN and is flagged."""
    bad = ~verified & (reference != "UNKNOWN")
    return F.struct(F.when(bad, "UNKNOWN").otherwise(reference).alias("reference"), bad.alias("suspected"))


def negate_claim(claim: Column, arabic: Column) -> Column:
    """The claim with its first key word negated, all its occurrences; else behind a negating prefix.

    English keys are looked for in lower case but replaced as they are, so `Permissible` stays.
    """

    def chain(pairs: list[tuple[str, str]], test: Column, other: Column) -> Column:
        out = other
        for old, new in reversed(pairs):
            out = F.when(test.contains(old), F.replace(claim, F.lit(old), F.lit(new))).otherwise(out)
        return out

    return F.when(arabic, chain(NEGATE_AR, claim, F.concat(F.lit(NEGATE_ELSE_AR), claim))).otherwise(chain(NEGATE_EN, F.lower(claim), F.concat(F.lit(NEGATE_ELSE_EN), F.lower(claim))))


def make_negative(claim: Column, context: Column, reference: Column, language: Column) -> Column:
    """Struct instruction, input, output, meta of the negated claim. Missing claim and context are empty, the language english."""
    language = F.coalesce(language, F.lit("english"))
    arabic = language == "arabic"
    wrong = negate_claim(F.coalesce(claim, F.lit("")), arabic)
    return F.struct(
        judge_instruction(F.coalesce(context, F.lit("")), wrong, arabic).alias("instruction"),
        F.lit("").alias("input"),
        verdict_output(F.lit("False"), F.when(arabic, WRONG_AR).otherwise(WRONG_EN), F.coalesce(reference, F.lit("UNKNOWN"))).alias("output"),
        F.struct(F.lit("incorrect").alias("type"), language.alias("language"), F.lit("rebalanced").alias("source")).alias("meta"),
    )


def prompt(task: str, language: Column, context: Column, claim: Column | None = None, count: int = 5) -> Column:
    """A request to a model for a task (`verify`, `qa`, `examples` or `batch`), in our own wording."""
    asks = {
        "verify": "Judge the claim by the context alone. Answer with a JSON object of verdict (True or False), explanation and reference (UNKNOWN if none is stated).",
        "qa": f"Write {count} questions on the text with their answers. Answer with a JSON object whose qa_pairs lists objects of question and answer.",
        "examples": "Write three to five varied claims on the seed, some correct and some not. Answer with a JSON array of type, claim, explanation and reference.",
        "batch": f"Write {count} claims on the context, half of them incorrect. Answer with a JSON array of type, claim, context, explanation and reference.",
    }
    parts = [F.lit(asks[task]), F.concat(F.lit("Answer in "), F.when(language.isin("ar", "arabic"), "Arabic").otherwise("English"), F.lit(".")), F.concat(F.lit("Context: "), context)]
    return F.concat_ws("\n\n", *parts, *([F.concat(F.lit("Claim: "), claim)] if claim is not None else []))
