"""Prompts that pipelines can name: what a model is asked, the JSON it is to answer with, and what stands for a missing answer.

The texts are this library's own; register others under other names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.plans.registry import Prompt, prompt


def shown(*parts: tuple[str, Column]) -> Column:
    """Named parts below one another; parts without text are left out."""
    return F.concat_ws("\n\n", *[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}:\n"), c)) for name, c in parts])


SUMMARIZE = prompt("summarize_entry", Prompt(
    "Sum up the entry in a few sentences. Use the document around it to make clear what it is about, and add nothing that neither of them says. Answer with JSON: {\"summary\": text}.",
    lambda text, document=None: shown(("Entry", text), *([] if document is None else [("Document", document)])), "summary STRING", {"summary": ""},
))

DESCRIBE = prompt("describe_image", Prompt(
    "Describe what the image shows, with the numbers and words in it, and write a caption of one line. Answer with JSON: {\"description\": text, \"caption\": text}.",
    lambda text: shown(("Text near the image", text)), "description STRING, caption STRING", {"description": "", "caption": ""},
))

CHUNK = prompt("chunk_text", Prompt(
    "Cut the text into chunks that can each be understood alone. Keep its words and their order, and leave nothing out. Answer with JSON: {\"chunks\": [text, ...]}.",
    lambda text: shown(("Text", text)), "chunks ARRAY<STRING>", {},
))

RATE = prompt("LLM_chunk_rubric", Prompt(
    "Rate the chunk from 0 to 5 for clear text, for coherence and for organization, and explain in a sentence. Answer with JSON: {\"text_clarity\": number, \"coherence\": number, \"organization\": number, \"explanation\": text}.",
    lambda text: shown(("Chunk", text)), "text_clarity STRING, coherence STRING, organization STRING, explanation STRING", {"text_clarity": "0", "coherence": "0", "organization": "0", "explanation": "no answer"},
))

COMPARE = prompt("LLM_relative_evaluation", Prompt(
    "Two ways to cut the same pages into chunks are shown. Say which keeps together what belongs together: A, B, or tie. Answer with JSON: {\"reasoning\": text, \"winner\": \"A\", \"B\" or \"tie\"}.",
    lambda a, b: shown(("A", a), ("B", b)), "reasoning STRING, winner STRING", {"reasoning": "no answer", "winner": "tie"},
))

LOOK = prompt("VLM_relative_evaluation", Prompt(
    "Pages are shown, and two ways to cut them into chunks. Say which keeps together what belongs together on the pages: A, B, or tie. Answer with JSON: {\"reasoning\": text, \"winner\": \"A\", \"B\" or \"tie\"}.",
    lambda a, b: shown(("A", a), ("B", b)), "reasoning STRING, winner STRING", {"reasoning": "no answer", "winner": "tie"},
))

CLAIMS = prompt("extract_claims", Prompt(
    "List the claims that the text makes, each as a sentence that can be understood alone. Answer with JSON: {\"items\": [text, ...]}.",
    lambda text: shown(("Text", text)), "items ARRAY<STRING>", {},
))

LABEL = prompt("label_cluster", Prompt(
    "The claims below belong together. Name what they have in common in a few words. Answer with JSON: {\"label\": text}.",
    lambda text: shown(("Claims", text)), "label STRING", {"label": ""},
))

QUESTIONS = prompt("generate_questions", Prompt(
    "Write questions that the text answers and that name what they ask about. Answer with JSON: {\"items\": [text, ...]}.",
    lambda text: shown(("Text", text)), "items ARRAY<STRING>", {},
))
