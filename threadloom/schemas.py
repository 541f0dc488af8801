"""Fixed schemas as DDL. Every scan names its schema, nothing is inferred."""

POSTS = (
    "post_id string, subreddit string, created_utc double, title string, "
    "selftext string, url string, permalink string, score bigint, "
    "num_comments bigint, upvote_ratio double, over_18 boolean, "
    "removed_by_category string"
)

COMMENTS = (
    "comment_id string, link_id string, parent_id string, body string, "
    "created_utc double, score bigint, depth int"
)

HAND_LABELS = (
    "post_id string, subreddit string, text_all string, "
    "anxiety_level int, anxiety_rating string"
)

MODEL_LABELS = (
    "post_id string, subreddit string, title string, text_preview string, "
    "ai_category string, ai_severity string, ai_confidence string"
)

LEXICON = "word string, emotion string, score string"

TOPIC_FEATURES = (
    "post_id string, subreddit string, nmf_topic int, nmf_label string, "
    "nmf_conf double"
)

METRICS = "section string, metric string, value string"
