"""Word lists, tables and constants that results depend on."""

#: Words that a search query's tokens leave out.
SEARCH_STOP_WORDS = """
a an the and or for in on at to of is it about that with by this my me i find show get
""".split()

#: Words that a keyword extraction leaves out.
KEYWORD_STOP_WORDS = """
a an the and or for in on at to of is it about that with by this my me i something anything some any show find get use
regarding context would could should want need looking related using used based
""".split()

#: Words that carry no event.
EVENT_STOP_WORDS = """
the a an and or but of to in on for with at by from as is are be this that it its into just now has have will you your via
about how why what after over than then they their i we our my goes go can single two three four five ve re ll s t m d don
doesn didn isn aren wasn weren won wouldn couldn shouldn hasn haven hadn im ive been being was were he she his her them not
no yes
""".split()

#: Words too common to name an event alone.
GENERIC_WORDS = """
anthropic openai google googledeepmind deepmind meta microsoft nvidia mistral xai ai model models new release releases
released launch launches launched ships shipped shipping update updates updated public version today first announces
announced announcement introducing introduces unveils unveiled open source sources weights weight tier safety api apis
code coding agent agents data cloud app apps tool tools use using used week year time people price prices free show hn
github blog post thread paper report field guide
""".split()

#: Query parameters that only track.
TRACKING_PARAMETERS = "fbclid gclid igshid mc_cid mc_eid ref ref_src".split()

#: Base score by content type (rows) and actionability (columns).
ACTIONABILITIES = ["actionable_now", "reference", "context_only", "none"]
BASE = {
    "launch": [70, 60, 48, 40],
    "benchmark": [66, 60, 46, 38],
    "field_report": [60, 52, 42, 34],
    "tutorial": [64, 58, 44, 34],
    "analysis": [56, 50, 40, 30],
    "news": [50, 44, 36, 28],
    "opinion": [40, 34, 25, 18],
    "promo": [5, 5, 5, 5],
    "reply_fragment": [0, 0, 0, 0],
}
SUBSTANCE = {"concrete": 3, "mixed": 0, "vague": -5}
OFF_TOPIC = {"core": 0, "adjacent": 0, "off": 40}
SAFE_LABELS = {"content_type": "opinion", "actionability": "context_only", "substance": "mixed", "on_topic": "adjacent"}
CONTENT_SYNONYMS = {
    "announcement": "launch", "release": "launch", "ship": "launch", "howto": "tutorial", "how_to": "tutorial",
    "guide": "tutorial", "review": "analysis", "deepdive": "analysis", "deep_dive": "analysis", "report": "field_report",
    "experience": "field_report", "take": "opinion", "commentary": "opinion", "thread": "analysis", "ad": "promo",
    "sponsored": "promo", "fragment": "reply_fragment", "reply": "reply_fragment",
}
ACTION_SYNONYMS = {
    "actionable": "actionable_now", "now": "actionable_now", "use_now": "actionable_now", "ref": "reference",
    "lookup": "reference", "context": "context_only", "background": "context_only", "na": "none", "nil": "none", "": "none",
}
SUBSTANCE_SYNONYMS = {
    "specific": "concrete", "detailed": "concrete", "solid": "concrete", "partial": "mixed", "some": "mixed",
    "empty": "vague", "thin": "vague", "fluff": "vague",
}
TOPIC_SYNONYMS = {
    "on": "core", "primary": "core", "related": "adjacent", "tangential": "adjacent", "off_topic": "off", "unrelated": "off",
}

#: Engagement, crowd, author, fit, recency and media terms.
ENGAGEMENT_K, ENGAGEMENT_CAP, ENGAGEMENT_CAP_UNKNOWN = 6, 15, 10
HN_K, HN_PIVOT, HN_CAP = 8, 50, 14
AUTHOR_LEADER, AUTHOR_TRACKED, FIT_CAP = 8, 6, 12
RECENCY = [(24, 10), (72, 6), (168, 3)]
MEDIA_VIDEO, MEDIA_IMAGE = 4, 2
TOP_GATE, ALSO_GATE, MAX_TOP, MAX_ALSO = 58, 50, 5, 2
LOW_REACH_FLOOR = 100

#: Lowest score of each grade.
GRADES = [(93, "A"), (90, "A-"), (87, "B+"), (83, "B"), (80, "B-"), (77, "C+"), (73, "C"), (70, "C-")]

#: Hybrid search weights, semantic, exact, lexical, source.
HYBRID = (0.38, 0.42, 0.17, 0.03)

#: Topic tag, category and pattern.
TOPIC_RULES = [
    ("ai-ml", "ai-resources", r"\b(ai|llm|gpt|claude|openai|anthropic|gemini|mistral|llama|agent|rag|embedding|machine learning|neural|model|evals?)\b"),
    ("developer-tools", "dev-tools", r"github|\bapi\b|typescript|javascript|python|fastapi|react|next\.js|node\.js|docker|kubernetes|terminal|cli|repo|code|developer|framework|library|sdk"),
    ("crypto-web3", "finance-crypto", r"\b(crypto|bitcoin|btc|eth|ethereum|solana|defi|nft|web3|wallet|blockchain|token|airdrop|memecoin)\b"),
    ("startups-business", "startups-business", r"startup|founder|fundrais|revenue|saas|yc\b|business|company|launch|customer"),
    ("security", "security-privacy", r"security|privacy|exploit|vulnerability|malware|phishing|encryption|auth|opsec|breach"),
    ("productivity", "productivity", r"productivity|workflow|automation|habit|focus|obsidian|notion|pkm|second brain|calendar"),
    ("finance", "finance-investing", r"stocks?|options|market|macro|invest|portfolio|inflation|federal reserve|rates?|earnings|trading"),
    ("design-product", "design", r"design|figma|ui\b|ux\b|typography|prototype|product|wireframe"),
    ("health", "health-wellness", r"health|fitness|sleep|longevity|nutrition|workout|biohack|supplement"),
    ("meme-humor", "funny-memes", r"meme|funny|lol|joke|humor|shitpost|satire|hilarious|comed"),
    ("news", "news", r"breaking|news|report|election|regulation|policy|lawsuit|geopolitic"),
]

#: Tool name and pattern.
TOOL_RULES = [
    ("OpenAI", r"\bopenai\b|\bgpt[- ]?\d*\b"),
    ("Claude", r"\bclaude\b|\banthropic\b"),
    ("GitHub", r"github\.com|\bgithub\b"),
    ("FastAPI", r"\bfastapi\b"),
    ("TypeScript", r"\btypescript\b|\bts\b"),
    ("JavaScript", r"\bjavascript\b|\bnode\.js\b"),
    ("Python", r"\bpython\b"),
    ("React", r"\breact\b"),
    ("Next.js", r"\bnext\.js\b|\bnextjs\b"),
    ("Docker", r"\bdocker\b"),
    ("Kubernetes", r"\bkubernetes\b|\bk8s\b"),
    ("Vercel", r"\bvercel\b"),
    ("Cursor", r"\bcursor\b"),
    ("Obsidian", r"\bobsidian\b"),
]

#: Categories that make a row relevant to a brief.
RELEVANT_CATEGORIES = """
ai-resources dev-tools finance-crypto startups-business security-privacy productivity finance-investing
""".split()
CODE_PATTERN = r"```|`[^`]+`|github\.com|\b(api|sdk|repo|code|typescript|javascript|python|fastapi|react|next\.js|docker|terminal|cli)\b"
LAUNCH_PATTERN = r"\b(launching|launched|introducing|announcing|we built|shipping|released|new product|now live)\b"
BENCHMARK_PATTERN = r"\b(benchmark|benchmarks|eval|evals|leaderboard|performance|latency|throughput|score|results?)\b"
