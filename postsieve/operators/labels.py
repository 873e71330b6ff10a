"""Label sets of the text models behind the classifier operators.

Fixed values: model names, the labels a model reports, and the names under which feeds ask for them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TextModel:
    model: str
    labels: dict[str, str]


CONTENT_MODERATION = TextModel(
    "KoalaAI/Text-Moderation",
    {
        "S": "sexual",
        "H": "hate",
        "V": "violence",
        "HR": "harassment",
        "SH": "self-harm",
        "S3": "sexual/minors",
        "H2": "hate/threatening",
        "V2": "violence/graphic",
        "OK": "OK",
    },
)

EMOTION_SENTIMENT = TextModel(
    "SamLowe/roberta-base-go_emotions",
    {
        "admiration": "Admiration",
        "amusement": "Amusement",
        "anger": "Anger",
        "annoyance": "Annoyance",
        "approval": "Approval",
        "caring": "Caring",
        "confusion": "Confusion",
        "curiosity": "Curiosity",
        "desire": "Desire",
        "disappointment": "Disappointment",
        "disapproval": "Disapproval",
        "disgust": "Disgust",
        "embarrassment": "Embarrassment",
        "excitement": "Excitement",
        "fear": "Fear",
        "gratitude": "Gratitude",
        "grief": "Grief",
        "joy": "Joy",
        "love": "Love",
        "nervousness": "Nervousness",
        "optimism": "Optimism",
        "pride": "Pride",
        "realization": "Realization",
        "relief": "Relief",
        "remorse": "Remorse",
        "sadness": "Sadness",
        "surprise": "Surprise",
        "neutral": "Neutral",
    },
)

_POLARITY = {"positive": "Positive", "negative": "Negative", "neutral": "Neutral"}
FINANCIAL_SENTIMENT = TextModel("ProsusAI/finbert", _POLARITY)
SENTIMENT = TextModel("cardiffnlp/twitter-xlm-roberta-base-sentiment-multilingual", _POLARITY)

LANGUAGE = TextModel(
    "papluca/xlm-roberta-base-language-detection",
    {
        "ja": "Japanese",
        "nl": "Dutch",
        "ar": "Arabic",
        "pl": "Polish",
        "de": "German",
        "it": "Italian",
        "pt": "Portuguese",
        "tr": "Turkish",
        "es": "Spanish",
        "hi": "Hindi",
        "el": "Greek",
        "ur": "Urdu",
        "bg": "Bulgarian",
        "en": "English",
        "fr": "French",
        "zh": "Chinese",
        "ru": "Russian",
        "th": "Thai",
        "sw": "Swahili",
        "vi": "Vietnamese",
    },
)

TOXICITY = TextModel(
    "unitary/toxic-bert",
    {
        "toxic": "Toxic",
        "identity_hate": "Identity Hate",
        "insult": "Insult",
        "obscene": "Obscene",
        "severe_toxic": "Severe Toxicity",
        "threat": "Threat",
    },
)

TOPIC = TextModel(
    "cardiffnlp/twitter-roberta-base-dec2021-tweet-topic-multi-all",
    {
        "arts_&_culture": "Arts & Culture",
        "business_&_entrepreneurs": "Business & Entrepreneurs",
        "celebrity_&_pop_culture": "Celebrity & Pop Culture",
        "diaries_&_daily_life": "Diaries & Daily Life",
        "family": "Family",
        "fashion_&_style": "Fashion & Style",
        "film_tv_&_video": "Film, TV & Video",
        "fitness_&_health": "Fitness & Health",
        "food_&_dining": "Food & Dining",
        "gaming": "Gaming",
        "learning_&_educational": "Learning & Educational",
        "music": "Music",
        "news_&_social_concern": "News & Social Concern",
        "other_hobbies": "Other Hobbies",
        "relationships": "Relationships",
        "science_&_technology": "Science & Technology",
        "sports": "Sports",
        "travel_&_adventure": "Travel & Adventure",
        "youth_&_student_life": "Youth & Student Life",
    },
)

TEXT_OPERATORS: dict[str, TextModel] = {
    "content_moderation": CONTENT_MODERATION,
    "emotion_sentiment_analysis": EMOTION_SENTIMENT,
    "financial_sentiment_analysis": FINANCIAL_SENTIMENT,
    "language_analysis": LANGUAGE,
    "sentiment_analysis": SENTIMENT,
    "toxicity_analysis": TOXICITY,
    "topic_analysis": TOPIC,
}

ZERO_SHOT_TEXT_MODEL = "MoritzLaurer/mDeBERTa-v3-base-xnli-multilingual-nli-2mil7"
ZERO_SHOT_IMAGE_MODEL = "openai/clip-vit-base-patch16"
NSFW_IMAGE_MODEL = "Falconsai/nsfw_image_detection"

# Labels by which a post's own author or a moderator marks adult content.
ADULT_LABELS = ("porn", "sexual", "graphic-media", "nudity")
