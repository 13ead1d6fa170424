"""A small sentiment word list: word -> (polarity, subjectivity).

Pass your own mapping to the operators to use another one.
"""

LEXICON: dict[str, tuple[float, float]] = {
    # praise
    "amazing": (0.6, 0.9),
    "awesome": (0.9, 1.0),
    "best": (0.9, 0.4),
    "better": (0.4, 0.5),
    "decent": (0.2, 0.6),
    "easy": (0.4, 0.8),
    "excellent": (0.9, 1.0),
    "fast": (0.3, 0.6),
    "fine": (0.3, 0.5),
    "friendly": (0.4, 0.5),
    "good": (0.7, 0.6),
    "great": (0.8, 0.75),
    "happy": (0.8, 1.0),
    "helpful": (0.5, 0.5),
    "liked": (0.5, 0.7),
    "love": (0.6, 0.6),
    "loved": (0.7, 0.8),
    "nice": (0.6, 0.9),
    "outstanding": (0.6, 0.9),
    "perfect": (0.9, 1.0),
    "quality": (0.1, 0.3),
    "recommend": (0.4, 0.5),
    "satisfied": (0.5, 0.8),
    "special": (0.35, 0.55),
    "reward": (0.2, 0.3),
    # complaint
    "average": (-0.1, 0.4),
    "awful": (-0.9, 1.0),
    "bad": (-0.7, 0.65),
    "below": (-0.2, 0.3),
    "broken": (-0.4, 0.4),
    "declined": (-0.4, 0.3),
    "disappointed": (-0.6, 0.75),
    "error": (-0.4, 0.3),
    "failed": (-0.5, 0.3),
    "fraud": (-0.6, 0.4),
    "horrible": (-0.9, 1.0),
    "late": (-0.3, 0.6),
    "never": (-0.2, 0.3),
    "overpriced": (-0.4, 0.6),
    "poor": (-0.5, 0.6),
    "problem": (-0.3, 0.3),
    "rude": (-0.4, 0.6),
    "slow": (-0.3, 0.4),
    "terrible": (-0.9, 1.0),
    "unable": (-0.5, 0.5),
    "waiting": (-0.2, 0.2),
    "worse": (-0.5, 0.6),
    "worst": (-0.9, 1.0),
    "wrong": (-0.5, 0.9),
}

NEGATIONS = ["no", "not", "nothing", "hardly"]
NEGATION_FACTOR = -0.5

INTENSIFIERS: dict[str, float] = {
    "absolutely": 1.3,
    "extremely": 1.4,
    "highly": 1.2,
    "really": 1.2,
    "so": 1.1,
    "very": 1.3,
    "slightly": 0.6,
    "somewhat": 0.7,
}

STOP_WORDS = [
    "a", "about", "all", "am", "an", "and", "any", "are", "as", "at", "be", "been", "but", "by",
    "can", "did", "do", "does", "for", "from", "get", "getting", "had", "has", "have", "her",
    "him", "his", "i", "if", "in", "into", "is", "it", "its", "me", "my", "no", "not", "of", "on",
    "or", "our", "please", "ref", "she", "since", "so", "some", "that", "the", "their", "them",
    "then", "there", "they", "this", "to", "up", "us", "was", "we", "were", "what", "when",
    "which", "who", "will", "with", "would", "you", "your",
]
