"""Word lists that the text rules use, as singular lower-case tokens."""

# These lists must hold exactly these words for the rules to give the same results.
STOP = ["a", "again", "all", "an", "and", "around", "at", "away", "body", "by", "central", "different", "for", "it", "its", "left", "of", "off", "out", "right", "same", "smallest", "the", "their", "them", "this", "those", "through", "to", "up", "using", "with"]
STRONG = ["carry", "close", "connect", "fold", "insert", "lift", "move", "nest", "open", "pick", "place", "plug", "pour", "remove", "retrieve", "separate", "stack", "transfer"]
GENERIC = ["adjust", "align", "handle", "hold", "interact", "manipulate", "position", "push", "reposition", "stabilize", "support", "tilt"]
PREP = ["align", "approach", "begin", "hover", "prepare", "reach", "start"]
ACTION_FILLER = ["continue", "grasp", "holding", "keep", "lifting", "make", "moving", "picking", "placing", "put", "release", "set"]
ROBOT = ["area", "arm", "gripper", "robot", "work", "workspace"]
FILLER = ["describe", "explain", "gesture", "gesturing", "instruction", "narrate", "wait"]
CONTAINER = ["bowl", "pan", "pot", "processor", "salad"]
PREP_INGREDIENT = ["chop", "crush", "cut", "dice", "flatten", "grate", "mince", "peel", "roll", "slice", "slit", "smash", "tear", "trim"]
RECIPE = ["add", "boil", "cook", "fill", "fold", "fry", "grind", "mix", "pour", "roll", "saute", "season", "sprinkle", "stir", "toast", "toss", "whisk"]
MIXING = ["mix", "season", "stir", "toss", "whisk"]
PHASE_NOUN = ["base", "content", "contents", "mixture", "sauce"]
REFERENCE = ["component", "food", "ingredient", "ingredients"]
DISH = ["salad"]
NOISE = ["adding", "additional", "combined", "finish", "mash", "season", "simmering", "smooth", "sprinkle", "stir", "together", "tong", "use", "well"]
ORDER = ["another", "eighth", "fifth", "final", "first", "fourth", "last", "next", "ninth", "second", "seventh", "sixth", "tenth", "third"]
ADDITIVE = ["butter", "liquid", "oil", "pepper", "salt", "seasoning", "spice", "spices", "sugar", "water"]
SEASONING = [*ADDITIVE, "five", "powder"]
UTENSIL = ["fork", "knife", "ladle", "masher", "processor", "spoon", "tong", "tongs"]
FOOD_SKIP = [*ADDITIVE, *UTENSIL, *PHASE_NOUN, *NOISE, "dish", "plate", "side", "top"]
INGREDIENT_SKIP = ["content", "ingredient", "mixture", "top", "topping"]
FAMILIES = {"add": ["add", "fill", "pour", "sprinkle"], "mix": MIXING, "cook": ["boil", "cook", "fry", "saute", "toast"], "prep": PREP_INGREDIENT, "transfer": ["move", "place", "remove", "transfer"]}
PLACES = ["to", "onto", "into", "over", "inside", "within", "toward", "towards", "from", "in", "on"]
FILLER_STARTS = ["wait", "explain", "describe", "narrate"]
HEATED = ["pan", "pot"]
SAUCE_BASE = ["liquid", "mixture", "onion", "sauce", "tomato"]
# Words of ordinal rounds: texts that differ in these alone are rounds of one step.
ROUND = ["10th", "11th", "12th", "1st", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th", "a", "an", "another", "eighth", "eleventh", "fifth", "final", "first", "fourth", "initial", "last", "next", "ninth", "second", "seventh", "sixth", "tenth", "the", "third", "twelfth"]

#: Words that are never the object or the destination of an instruction.
COMMON = [*STOP, *STRONG, *GENERIC, *PREP, *ACTION_FILLER, *ROBOT, "new"]
#: Words that say what is done rather than to what.
DOING = [*STRONG, *GENERIC, *PREP, *PREP_INGREDIENT, *RECIPE, *PHASE_NOUN, *NOISE, *UTENSIL]
#: Below this support of a boundary, shared actions may join two segments.
SUPPORT_CEILING = 1.2


def rows() -> list[tuple[str, str]]:
    """(list, word) of all lists, for joins and for SQL."""
    return [(name.lower(), word) for name, words in sorted(globals().items()) if name.isupper() and isinstance(words, list) for word in sorted(set(words))]
