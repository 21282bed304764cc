"""The values that labels of files, texts, acoustics and speakers may take."""

# Fixed values.
TEXT = {
    "domain": [
        "podcast", "audiobook", "news", "interview", "lecture", "drama", "documentary", "conversation", "monologue", "education", "entertainment",
        "religion", "advertisement", "unknown",
    ],
    "scenario": [
        "tech", "business", "science", "history", "politics", "lifestyle", "true_crime", "comedy", "fiction", "non_fiction", "self_help", "sports",
        "music_review", "health", "finance", "religion", "kids", "language_learning", "philosophy", "general", "unknown",
    ],
    "style": [
        "neutral", "narrative", "dialogue", "debate", "scripted", "spontaneous", "expressive", "calm", "energetic", "formal", "casual", "humorous",
        "serious", "unknown",
    ],
}
ACOUSTIC = {
    "environment": ["studio", "indoor_quiet", "indoor_noisy", "outdoor", "vehicle", "phone_call", "online_meeting", "live_event", "unknown"],
    "background": ["clean", "music", "noise", "applause", "ambient", "speech_overlap", "echo_reverb", "unknown"],
    "quality": ["professional", "semi_pro", "mobile", "low", "very_low", "unknown"],
}
SPEAKER = {
    "gender": ["male", "female", "unknown"],
    "age_group": ["child", "teen", "young_adult", "adult", "senior", "unknown"],
    "accent": ["native_standard", "native_regional", "foreign", "non_standard", "unknown"],
}
ALL = TEXT | ACOUSTIC | SPEAKER
