"""Settings of the linking flow: two profiles, plus the fixed lists that guards and classes use."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Weights of evidence by source type and subtype.
EVIDENCE_WEIGHTS = {
    ("BAI_HOC", "full"): 1.00,
    ("BAI_HOC", "title_only"): 0.30,
    ("CLO", "KIEN_THUC"): 0.90,
    ("CLO", "KY_NANG"): 0.85,
    ("CLO", "TU_CHU_TRACH_NHIEM"): 0.20,
    ("CLO", None): 0.85,
    ("MUC_TIEU", "KIEN_THUC"): 0.70,
    ("MUC_TIEU", "KY_NANG"): 0.65,
    ("MUC_TIEU", "TU_CHU_TRACH_NHIEM"): 0.15,
    ("MO_TA", None): 0.25,
}
DEFAULT_WEIGHT = 0.30

# Sentences that say nothing about a course (searched in trimmed lower case).
BOILERPLATE = (
    r"proactive.{0,20}(learn|eager|attitude)",
    r"self.?disciplin",
    r"serious (learning|work) attitude",
    r"comprehensive(ly)? apply (knowledge|skills)",
    r"apply (acquired|comprehensive) knowledge",
    r"(practical|implement).{0,15}(information system|IT|technology project)",
    r"(accepting|receive).{0,10}(task|assignment|internship)",
    r"^writing report$",
    r"^planning and survey(ing)?$",
    r"^executing tasks?$",
    r"^(receiving|accepting) (the )?assignment$",
)

# Marks of grading events.
GRADING = ("advisor grade", "reviewer grade", "final grade", "assessment method", "grading criteria")

# Keywords that class a learning outcome; the first class with a hit wins.
OUTCOME_ATTITUDE = ("learning attitude", "thái độ học tập", "self-disciplin", "tự giác", "cầu thị")
OUTCOME_KNOWLEDGE = ("knowledge", "understand", "explain", "describe", "kiến thức", "hiểu", "trình bày", "nắm vững")

# Keywords that class a concept, in the order in which the classes are tried.
CONCEPT_INTERPERSONAL = (
    "teamwork", "làm việc nhóm", "communication", "giao tiếp",
    "collaboration", "hợp tác", "leadership", "lãnh đạo",
    "presentation", "thuyết trình", "negotiation", "đàm phán",
    "empathy", "conflict resolution", "mentoring",
)
CONCEPT_COGNITIVE = (
    "thinking", "tư duy", "logic", "reasoning", "analysis", "phân tích",
    "problem solving", "giải quyết vấn đề", "critical", "abstract",
    "computational", "algorithmic", "pattern recognition", "decomposition",
    "systematic", "analytical", "evaluate", "đánh giá", "synthesis",
    "attention to detail", "precision", "troubleshooting", "debugging",
)
CONCEPT_METHODOLOGICAL = (
    "research", "nghiên cứu", "methodology", "phương pháp",
    "planning", "lập kế hoạch", "project management", "quản lý",
    "documentation", "tài liệu", "workflow", "process",
    "time management", "organization", "procedural",
    "persistence", "self-learning", "tự học",
)

# Skills of other domains, by identifier and by groups of keywords.
BLOCKED_URIS = (
    "http://data.europa.eu/esco/skill/e8f80ec5-c423-4eb2-9f0f-805d22f844ae",
    "http://data.europa.eu/esco/skill/118efbcd-8fc5-4668-81d1-c383a0d16070",
    "http://data.europa.eu/esco/skill/a3ce2bf7-5562-4639-9b52-fdb4850a3904",
    "http://data.europa.eu/esco/skill/946c1229-1171-40d4-82cc-fe3f483ca100",
    "http://data.europa.eu/esco/skill/114c9698-c999-4369-8498-81bf641fe871",
    "http://data.europa.eu/esco/skill/f2c63b7a-ed6c-4890-9f8c-7685d172624c",
    "http://data.europa.eu/esco/skill/ccdbd9bb-4faf-403c-a968-e8bf487f8a53",
)
BLOCKED_KEYWORDS = (
    ("accident", "occupational safety", "workplace injury"),
    ("patient", "nursing", "clinical", "medical treatment"),
    ("livestock", "agricultural", "crop", "harvest"),
)
# Offensive security.
OFFENSIVE_URIS = ("http://data.europa.eu/esco/skill/af313ba1-a39e-49ac-99ec-94630fbe4f7f",)
OFFENSIVE_KEYWORDS = (
    "exploit", "penetration test", "intrusion", "malware",
    "reverse engineer", "vulnerability exploit", "ethical hack",
)
# Frameworks and their short names; the first that a label names decides.
FRAMEWORKS = (
    ("control objectives for information and related technology", ("cobit",)),
    ("information technology infrastructure library", ("itil",)),
    ("iso/iec 27001", ("iso 27001", "iso27001", "isms")),
    ("information security management system", ("isms", "iso 27001", "iso27001")),
    ("the open group architecture framework", ("togaf",)),
    ("capability maturity model integration", ("cmmi",)),
    ("project management body of knowledge", ("pmbok",)),
    ("prince2", ("prince2",)),
)
# Capstone courses.
CAPSTONE_CODES = ("IT6205", "IT6206", "IT6207", "IT6208")
CAPSTONE_KEYWORDS = ("internship", "graduation thesis", "graduation project", "final project")
# Courses left out by a word of their name.
IGNORED_COURSES = (
    "triết học", "chính trị", "mác - lênin", "mác-lênin", "tư tưởng hồ chí minh", "đảng cộng sản",
    "chủ nghĩa xã hội", "pháp luật đại cương", "kinh tế", "âm nhạc", "giáo dục thể chất", "quốc phòng", "ngoại ngữ",
)
# Translations of closed lists.
GROUP_KIND = {"BAT_BUOC": "Required", "TU_CHON": "Elective"}
RELATION_KIND = {"TIEN_QUYET": "Prerequisite", "HOC_TRUOC": "Prior Study"}
# Codes of the taxonomy that are in the domain.
DOMAIN_CODES = ("13", "25", "35")
# Sections that give a course its type.
SECTION_TYPE = {"I.2": "FOUNDATIONAL", "II.2": "CORE", "II.3": "SPECIALIZED"}


@dataclass(frozen=True)
class Profile:
    """Thresholds by concept type: (primary, secondary, optional, overflow)."""

    skill: tuple[float, float, float, float] = (0.85, 0.75, 0.60, 0.40)
    knowledge: tuple[float, float, float, float] = (0.80, 0.65, 0.50, 0.35)
    query_top_k: int = 50
    fusion_top_k: int = 50
    supports_top_n: int = 30
    rrf_k: int = 60
    rerank_top_k: int = 30
    rerank_weight: float = 0.7
    rrf_weight: float = 0.3
    low_quality: float = 0.35
    sparse_ratio: float = 0.60
    mismatch_penalty: float = 0.025
    strong_bonus: float = 0.010
    capstone_threshold: float = 0.740
    capstone_cap: int = 10
    capstone_min_weight: float = 0.40
    blocked_uris: tuple[str, ...] = BLOCKED_URIS[:1]
    ignored_courses: tuple[str, ...] = IGNORED_COURSES
    caps: tuple[tuple[str, str, int], ...] = (
        ("FOUNDATIONAL", "skill", 7),
        ("FOUNDATIONAL", "knowledge", 13),
        ("CORE", "skill", 15),
        ("CORE", "knowledge", 15),
        ("SPECIALIZED", "skill", 25),
        ("SPECIALIZED", "knowledge", 15),
    )
    default_cap: int = 15


CODE_DEFAULTS = Profile()
YAML_DEFAULTS = replace(
    CODE_DEFAULTS,
    skill=(0.88, 0.80, 0.75, 0.60),
    knowledge=(0.85, 0.75, 0.70, 0.55),
    rerank_top_k=100,
    capstone_threshold=0.820,
    capstone_min_weight=0.50,
    blocked_uris=BLOCKED_URIS,
    ignored_courses=IGNORED_COURSES[:8],
)
PROFILES = {"code_defaults": CODE_DEFAULTS, "yaml_defaults": YAML_DEFAULTS}


def load_profile(path: str | None = None, base: str = "code_defaults") -> Profile:
    """A profile with the values of a JSON or YAML file (``.yaml``, ``.yml``; needs PyYAML) laid over it; lists become tuples."""
    import json

    if path is None:
        return PROFILES[base]
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as missing:
                raise ImportError(f"{path}: reading YAML needs PyYAML") from missing
            raw = yaml.safe_load(f) or {}
        else:
            raw = json.load(f)
    tuples = lambda x: tuple(map(tuples, x)) if isinstance(x, list) else x
    return replace(PROFILES[base], **{k: tuples(v) for k, v in raw.items()})
