"""Field registry: canonical fields, their aliases, and name resolution."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Canonical fields and aliases in order of registration. Fixed values.
DEFAULT_FIELDS = {
    "full_name": (
        "str", "name", "full name", "candidate name", "candidate_name", "applicant name", "applicant_name", "fullname", "contact name",
        "contact_name", "person name"),
    "first_name": ("str", "first name", "firstname", "given name", "given_name", "fname", "forename"),
    "last_name": ("str", "last name", "lastname", "surname", "family name", "family_name", "lname"),
    "emails": ("list[str]", "email", "email address", "email_address", "e-mail", "e_mail", "mail", "electronic mail"),
    "phones": (
        "list[str]", "phone", "phone number", "phone_number", "mobile", "mobile number", "mobile_number", "cell", "cell phone", "telephone",
        "tel", "contact number", "contact_number"),
    "location": (
        "str", "location", "city", "city state", "city_state", "address", "current location", "current_location", "residence", "region", "area"),
    "headline": (
        "str", "headline", "title", "job title", "job_title", "current title", "current_title", "position", "professional title",
        "professional_title", "role", "designation"),
    "summary": (
        "str", "summary", "bio", "about", "about me", "profile", "professional summary", "professional_summary", "objective",
        "career objective", "introduction", "overview", "description"),
    "current_company": (
        "str", "company", "current company", "current_company", "employer", "current employer", "current_employer", "organization",
        "organisation", "org", "company name", "company_name"),
    "current_title": ("str", "current title", "current_title", "current position", "current_position", "latest title", "recent title"),
    "experience": (
        "list[dict]", "experience", "work experience", "work_experience", "employment", "employment history", "employment_history",
        "work history", "work_history", "jobs", "positions", "career", "professional experience"),
    "years_of_experience": (
        "float", "years of experience", "years_of_experience", "yoe", "total experience", "total_experience", "experience years",
        "experience_years"),
    "education": (
        "list[dict]", "education", "educational background", "educational_background", "academics", "academic background", "qualifications",
        "degrees", "schooling"),
    "skills": (
        "list[str]", "skills", "skill set", "skill_set", "skillset", "technical skills", "technical_skills", "technologies", "tech stack",
        "tech_stack", "competencies", "expertise", "tools", "languages", "programming languages", "programming_languages"),
    "certifications": ("list[str]", "certifications", "certificates", "certification", "professional certifications", "awards", "licences"),
    "projects": ("list[dict]", "projects", "project", "side projects", "personal projects", "open source", "open_source", "portfolio"),
    "github_url": ("str", "github", "github url", "github_url", "github profile", "github_profile", "github link", "gh"),
    "github_username": ("str", "github username", "github_username", "github handle", "github login"),
    "linkedin_url": ("str", "linkedin", "linkedin url", "linkedin_url", "linkedin profile", "linkedin_profile", "linkedin link", "li"),
    "website": (
        "str", "website", "website url", "website_url", "portfolio", "personal website", "personal_website", "blog", "homepage", "url", "web"),
    "github_stars": ("int", "github stars", "github_stars", "total stars", "total_stars", "stars"),
    "github_repos": ("int", "github repos", "github_repos", "public repos", "public_repos", "repositories"),
    "primary_language": ("str", "primary language", "primary_language", "top language", "main language"),
}

#: Source columns that are left out on purpose. Fixed values.
IGNORED_COLUMNS = frozenset(
    (
        "id", "candidate id", "candidate_id", "applicant id", "applicant_id", "record id", "record_id", "row id", "row_id", "internal id",
        "internal_id", "ats id", "ats_id", "created at", "created_at", "updated at", "updated_at", "modified at", "modified_at", "stage",
        "pipeline stage", "recruiter", "recruiter name", "recruiter_name", "owner", "source", "source name", "source_name", "referral",
        "rejection reason", "rejection_reason", "status", "notes",
    )
)


@dataclass
class FieldRegistry:
    """Names to canonical fields. A canonical name always wins; an alias goes to the first field that takes it."""

    kinds: dict[str, str] = field(default_factory=dict)
    names: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: set[str] = field(default_factory=set)

    @classmethod
    def default(cls) -> FieldRegistry:
        reg = cls()
        for canonical, (kind, *aliases) in DEFAULT_FIELDS.items():
            reg.register(canonical, aliases, kind)
        return reg

    def register(self, canonical: str, aliases=(), kind: str = "str", required: bool = False) -> None:
        self.kinds[canonical] = kind
        self.aliases[canonical] = tuple(aliases)
        self.names[canonical.lower()] = canonical
        for a in aliases:
            self.names.setdefault(a.strip().lower(), canonical)
        if required:
            self.required.add(canonical)

    def replace(self, canonical: str, aliases=(), kind: str = "str", required: bool = False) -> None:
        """Register anew, giving up the field's earlier aliases."""
        for a in self.aliases.get(canonical, ()):
            self.names.pop(a.strip().lower(), None)
        self.register(canonical, aliases, kind, required)

    def resolve(self, name: str) -> str | None:
        return self.names.get(name.strip().lower())

    def as_table(self, spark: SparkSession) -> DataFrame:
        """``(alias, canonical)`` for names that are data and not columns; about 200 rows."""
        return spark.createDataFrame(sorted(self.names.items()), "alias string, canonical string")
