from .hashing import hash_percent, hash_word, poisson_one
from .predicates import in_domain, in_range
from .student import two_sided_p

__all__ = ["hash_percent", "hash_word", "in_domain", "in_range", "poisson_one", "two_sided_p"]
