"""Word lists, phrase lists and rules whose exact content decides the results."""

# Words that count as technical vocabulary.
TECH_WORDS = (
    "architecture architectural pattern topology distributed consensus replication partition sharding transaction consistency availability scalability "
    "throughput latency redundancy failover microservice monolith decoupling bounded aggregate domain cqrs outbox pubsub event messaging database cache "
    "storage resilience fault circuit protocol component interface api pipeline stream"
).split()

# Words that mark trade-offs in a document.
TRADEOFF_WORDS = (
    "tradeoff trade-off alternative alternatives advantage disadvantage benefit drawback compromise overhead bottleneck rationale decision risk limitation "
    "consequence versus vs pro con"
).split()

# Substrings that signal architecture reasoning.
REASONING_SIGNALS = [
    "trade-off", "tradeoff", "alternative", "decision", "consequence", "constraint", "scalability", "consistency", "availability", "latency", "throughput",
    "failure", "replication", "partition", "transaction", "idempotency", "retry", "timeout", "resilience", "coupling", "cohesion", "boundary", "module",
    "service", "deployment", "data model", "storage", "queue", "messaging", "reliability", "maintainability", "migration", "rationale", "fault tolerance",
    "event-driven",
]

# Labels of a decision record.
RECORD_LABELS = ["context", "decision", "consequences", "alternatives", "status", "rationale"]

# File names and titles of project metadata, as patterns on lower-case text.
METADATA_PATHS = [
    r"contributing\.md$", r"code_of_conduct\.md$", r"changelog\.md$", r"releasenotes\.", r"issue_template", r"pull_request_template", r"governance\.md$",
    r"citation\.cff$", r"template\.md$",
]
METADATA_TITLES = [
    "^contributing to", "^code of conduct", "^release notes", "^changelog", "^how to contribute", "^governance", "^bug report", "^feature request",
]

# The legal categories, and hints that stand for one of them.
CATEGORIES = [
    "distributed_systems", "reliability_resilience", "software_architecture", "domain_driven_design", "messaging_event_driven",
    "database_data_architecture", "system_design", "networking_systems", "adr_decision_reasoning", "ai_agent_architecture",
]
HINT_CATEGORIES = {"architecture_patterns": "software_architecture", "cloud_architecture": "software_architecture", "adr": "adr_decision_reasoning"}

# The concepts with the phrases that name them, besides the concept's own name.
CONCEPT_PHRASES = {
    "aggregate": ["aggregates"],
    "api-design": ["api design", "api architecture"],
    "availability": ["high availability"],
    "backpressure": ["back pressure"],
    "bounded-context": ["bounded context"],
    "caching": ["cache"],
    "concurrency": ["concurrent", "race condition"],
    "consensus": ["paxos", "raft"],
    "consistency": ["strong consistency"],
    "distributed-transactions": ["distributed transactions", "distributed transaction"],
    "domain-event": ["domain event", "domain events"],
    "eventual-consistency": ["eventual consistency"],
    "failover": ["active-passive"],
    "failure-detection": ["failure detection", "failure detector"],
    "fault-tolerance": ["fault tolerance", "fault tolerant"],
    "idempotency": ["idempotent"],
    "indexing": ["database index", "indexes"],
    "leader-election": ["leader election"],
    "load-balancing": ["load balancing"],
    "messaging": ["message broker", "message queue"],
    "observability": ["metrics", "monitoring"],
    "outbox": ["transactional outbox", "outbox pattern"],
    "partitioning": ["data partition", "partition key"],
    "quorum": [],
    "recovery": ["disaster recovery"],
    "replication": ["replicated log", "log replication"],
    "saga": ["saga pattern"],
    "scalability": ["scalable", "scale out"],
    "security": ["authentication", "authorization", "threat model"],
    "sharding": ["shard"],
    "storage": ["persistent storage"],
    "streaming": ["event stream"],
    "tracing": ["trace context", "distributed trace"],
    "transactions": ["transaction", "atomicity"],
}

# Concepts that speak for a category.
CATEGORY_CONCEPTS = {
    "distributed_systems": ["consensus", "replication", "leader-election", "quorum", "consistency", "failure-detection"],
    "reliability_resilience": ["fault-tolerance", "failover", "recovery", "availability", "backpressure"],
    "messaging_event_driven": ["messaging", "streaming", "idempotency", "outbox", "saga"],
    "domain_driven_design": ["bounded-context", "aggregate", "domain-event"],
    "database_data_architecture": ["storage", "indexing", "sharding", "partitioning", "transactions"],
    "software_architecture": ["api-design", "security", "observability", "tracing"],
    "system_design": ["scalability", "caching", "load-balancing"],
}

# Phrases reported as candidates for new concepts.
CANDIDATE_PHRASES = {"anti-entropy": "anti-entropy", "clock ordering": "clock-ordering", "lease-based leadership": "lease-based-leadership", "logical clocks?": "logical-clocks"}

# Terms of the response rubric.
RUBRIC = {
    "nfr_coverage": ["availability", "latency", "scalability", "consistency", "security", "cost", "reliability"],
    "architecture_choice_quality": ["monolith", "microservices", "modular monolith", "event-driven", "cqrs", "event sourcing", "hexagonal", "layered", "serverless", "crud"],
    "tradeoff_quality": ["tradeoff", "trade-off", "however", "on the other hand", "downside", "drawback", "benefit", "cost", "compromise", "versus", "vs"],
    "alternative_analysis": ["alternative", "option", "instead of", "could also", "consider"],
    "risk_identification": ["risk", "failure", "single point of failure", "spof", "bottleneck", "complexity"],
    "reliability_reasoning": ["retry", "circuit breaker", "timeout", "bulkhead", "outbox", "dlq", "dead letter", "rate limit", "backoff"],
    "scalability_reasoning": ["partition", "shard", "cache", "read replica", "index", "load balancer", "horizontal"],
    "operational_complexity_awareness": ["deployment", "operational", "monitoring", "observability", "team skill", "maintenance"],
    "cost_awareness": ["cost", "budget", "expensive", "cloud spend", "financial", "billing"],
    "revisit_conditions": [
        "p95", "p99", "latency", "cpu", "memory", "i/o", "io", "connection pool", "queue lag", "incident", "failure rate", "team ownership",
        "deployment frequency", "throughput", "rps", "qps", "db load", "revisit", "threshold",
    ],
    "clarification_awareness": ["clarify", "unknown", "missing information", "depends on", "unspecified", "budget is not stated"],
}
# How many hits give a full score; the other lists score 0.8 for any hit and else 0.2.
RUBRIC_FULL = {"nfr_coverage": 4, "tradeoff_quality": 3, "reliability_reasoning": 2, "scalability_reasoning": 2, "revisit_conditions": 3}

# Absolute claims, as patterns on lower-case text.
ABSOLUTE_CLAIMS = [
    r"microservices?\s+(are\s+)?always\s+(required|needed|better)", r"kubernetes?\s+automatically\s+provides\s+high\s+availability",
    r"nosql\s+is\s+(always\s+)?faster\s+than\s+sql", r"event-driven\s+architecture\s+guarantees\s+scalability", r"always\s+(use|choose)\s+microservices",
    r"never\s+use\s+a?\s*monolith",
]

# Document kinds by file suffix.
CONTENT_TYPES = {"md": "markdown", "markdown": "markdown", "adoc": "asciidoc", "html": "html", "htm": "html", "txt": "text", "rst": "restructuredtext"}

# Concerns by status of the license review.
LICENSE_CONCERNS = {
    "approved": [],
    "mixed": ["mixed content/license classes"],
    "restrictive": ["restrictive terms"],
    "unverified": ["no verified reusable-content license"],
    "noncommercial": ["non-commercial restriction"],
    "custom_terms": ["custom/restrictive author terms"],
}
LICENSE_CONCERN_OTHERWISE = "manual license review required"

# Categories of the manual review sample, in order.
REVIEW_CATEGORIES = ["cloud_architecture", "architecture_patterns", "distributed_systems", "reliability", "database_architecture", "adr", "domain_driven_design"]
