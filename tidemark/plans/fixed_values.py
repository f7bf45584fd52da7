"""Fixed values of the flows: mappings, rates, tiers and declared metadata."""

from tidemark.operators.scd import Tier, Version

# Columns the raw tables must have.
ARTICLE_REQUIRED = ("article_id", "title", "company_name", "published_date", "category", "summary", "url")
COMPANY_REQUIRED = ("company_name", "industry", "founded_year", "headquarters")

# Company aliases.
COMPANY_ALIASES = {
    "AWS": "Amazon Web Services",
    "Amazon Web Services (AWS)": "Amazon Web Services",
    "CloudFlare": "Cloudflare",
    "Data Robot": "DataRobot",
    "Databricks Inc.": "Databricks",
    "DeepMind": "Google DeepMind",
    "Google Deepmind": "Google DeepMind",
    "Facebook AI Research": "Meta AI",
    "Meta AI Research": "Meta AI",
    "Azure": "Microsoft",
    "Microsoft Azure": "Microsoft",
    "Mongo DB": "MongoDB",
    "Nvidia": "NVIDIA",
    "NVIDIA Corporation": "NVIDIA",
    "Open AI": "OpenAI",
    "OpenAI Inc.": "OpenAI",
    "Palantir Technologies": "Palantir",
    "Snowflake Inc.": "Snowflake",
    "The Boring Company / SpaceX": "SpaceX",
    "Stripe Inc.": "Stripe",
}

# Category labels and their codes.
CATEGORY_CODES = {
    "AI & ML": "AI_ML",
    "Artificial Intelligence": "AI_ML",
    "Machine Learning": "AI_ML",
    "AI/ML": "AI_ML",
    "Cloud": "Cloud_Computing",
    "Cloud Services": "Cloud_Computing",
    "Cloud Computing": "Cloud_Computing",
    "Cybersecurity": "Cybersecurity",
    "InfoSec": "Cybersecurity",
    "Security": "Cybersecurity",
    "Data Analytics": "Data_Analytics",
    "Analytics": "Data_Analytics",
    "Big Data": "Data_Analytics",
    "FinTech": "FinTech",
    "Finance": "FinTech",
    "Financial Technology": "FinTech",
    "Enterprise Software": "Enterprise_Software",
    "Software": "Enterprise_Software",
    "SaaS": "SaaS",
}

# Rates to USD.
RATES_TO_USD = {"USD": 1.0, "GBP": 1.27, "EUR": 1.1, "JPY": 1 / 150}

# Loyalty tiers by lifetime spend, with the versions that lead to each.
LOYALTY_TIERS = (
    Tier("Platinum", 15_000, (
        Version("Silver", 10_000, "1996-01-01", "1997-06-30"),
        Version("Gold", 25_000, "1997-07-01", "1998-03-31"),
        Version("Platinum", 50_000, "1998-04-01"),
    )),
    Tier("Gold", 5_000, (
        Version("Bronze", 5_000, "1996-01-01", "1997-12-31"),
        Version("Gold", 20_000, "1998-01-01"),
    )),
    Tier("Bronze", 0, (Version("Bronze", 5_000, "1996-01-01"),)),
)
SIGNUP_DATE = "1996-01-01"
SIGNUP_CREDIT_LIMIT = 5_000

# Allowed values of the contracts.
ALLOWED_CATEGORIES = (
    "AI_ML", "Cloud_Computing", "Data_Analytics", "FinTech", "Cybersecurity", "SaaS",
    "Enterprise_Software", "Hardware", "Other",
)
ALLOWED_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
ALLOWED_STOCK = ("In Stock", "Low Stock", "Out of Stock")

# What each warehouse table holds and what its keys point to.
TABLE_DESCRIPTIONS = {
    "dim_company": "One row per company: industry, headquarters, size, listing and founding year.",
    "fct_article": "One row per article: date, category, author, word count, text and address.",
    "fct_arr_observation": "One row per known revenue figure, in USD and in millions of USD.",
    "agg_company_quarterly_arr": "Revenue per company and quarter: count, latest, mean, highest, lowest.",
    "view_company_latest_arr": "The latest revenue figure per company.",
}
FOREIGN_KEYS = (
    ("fct_article", "company_id", "dim_company", "company_id"),
    ("fct_arr_observation", "article_id", "fct_article", "article_id"),
    ("fct_arr_observation", "company_id", "dim_company", "company_id"),
    ("agg_company_quarterly_arr", "company_id", "dim_company", "company_id"),
    ("view_company_latest_arr", "company_id", "dim_company", "company_id"),
)
