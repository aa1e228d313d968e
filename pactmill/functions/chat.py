"""Chat messages, template rendering and inference requests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pactmill import fixed_values as fv


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def example(instruction: Column, response: Column, system: Column | None = None) -> Column:
    """A three-message example: system, user, assistant."""
    prompt = F.lit(fv.SYSTEM_PROMPT) if system is None else system
    return F.array(message("system", prompt), message("user", instruction), message("assistant", response))


def render(messages: Column) -> Column:
    """ChatML text of an array of (role, content) messages, without a generation marker. A NULL role or content counts as
    empty."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit(fv.IM_START), F.coalesce(m["role"], F.lit("")), F.lit("\n"), F.coalesce(m["content"], F.lit("")),
                F.lit(fv.IM_END + "\n"),
            ),
        ),
        "",
    )


def inference_messages(instruction: Column, system: Column | None = None) -> Column:
    prompt = F.lit(fv.SYSTEM_PROMPT) if system is None else system
    return F.array(message("system", prompt), message("user", instruction))


def render_prompt(messages: Column) -> Column:
    """ChatML text that ends where the assistant starts to answer."""
    return F.concat(render(messages), F.lit(fv.IM_START + "assistant\n"))


def request(
    instruction: Column,
    model: str = fv.MODEL_NAME,
    temperature: float = fv.TEMPERATURE,
    max_tokens: int = fv.MAX_TOKENS,
    stream: bool = False,
) -> Column:
    """Request payload with sampling options, as JSON text."""
    options = F.struct(
        F.lit(float(temperature)).alias("temperature"),
        F.lit(max_tokens).alias("num_predict"),
        F.lit(fv.TOP_P).alias("top_p"),
        F.lit(fv.TOP_K).alias("top_k"),
        F.lit(fv.REPEAT_PENALTY).alias("repeat_penalty"),
    )
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            inference_messages(instruction).alias("messages"),
            F.lit(stream).alias("stream"),
            options.alias("options"),
        )
    )


def example_request(category: Column, action: Column) -> Column:
    """Text of the request that asks for one generated example of a category and an action."""
    return F.format_string(fv.EXAMPLE_REQUEST, category, action)
