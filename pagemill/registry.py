"""What the package offers to callers by name: tools with their schemas and what they may touch, and commands."""

from __future__ import annotations

from dataclasses import dataclass, field

NETWORK = "network-read"


@dataclass(frozen=True)
class Tool:
    name: str
    description: str
    schema: dict
    authority: str = NETWORK
    #: calls of the tool within its interval are limited to ten
    refill_ms: int = 0


@dataclass
class Registry:
    name: str
    version: str
    tools: list[Tool] = field(default_factory=list)
    commands: dict[str, str] = field(default_factory=dict)

    def tool(self, tool: Tool) -> None:
        """Adds a tool; of two with one name the first answers."""
        self.tools.append(tool)

    def command(self, name: str, description: str) -> None:
        self.commands.setdefault(name, description)

    def find(self, name: str) -> Tool | None:
        return next((t for t in self.tools if t.name == name), None)


def version_text(name: str = "pagemill", build: str = "") -> str:
    """The package with its version and the build it came from."""
    from pagemill import __version__

    return f"{name} {__version__}" + (f" ({build})" if build else "")


def _object(required: list[str], **properties: str) -> dict:
    return {"type": "object", "required": required, "properties": {k: {"type": v} if v != "array" else {"type": "array", "items": {"type": "string"}} for k, v in properties.items()}}


def default_registry() -> Registry:
    from pagemill import __version__

    r = Registry("web", __version__)
    r.tool(Tool("web_search", "Search the web.", _object(["query"], query="string", count="integer", freshness="string", include_domains="array", exclude_domains="array", depth="string"), refill_ms=5000))
    r.tool(Tool("web_fetch", "A page as text, in windows.", _object(["url"], url="string", max_chars="integer", offset="integer", user_agent="string"), refill_ms=2000))
    r.tool(Tool("web_images", "The images of a page.", _object(["url"], url="string")))
    r.tool(Tool("web_links", "The links of a page.", _object(["url"], url="string")))
    r.tool(Tool("web_fetch_raw", "A page's source, saved to a file.", _object(["url", "save_path"], url="string", save_path="string", overwrite="boolean", user_agent="string")))
    r.tool(Tool("web_fetch_image", "An image, scaled down if asked for.", _object(["url"], url="string", max_dimension="integer", save_path="string", overwrite="boolean", inject="boolean", user_agent="string")))
    r.command("web-cache", "Shows or clears the page cache.")
    return r
