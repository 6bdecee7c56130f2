"""The standard's HTML tokenizer, one character and one state at a time."""

SPACES = "\t\n\f\r "
TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def is_letter(c):
    return "a" <= low(c) <= "z" and len(c) == 1


class Machine:
    def __init__(self, html):
        self.html, self.at, self.tags = html, 0, []

    def next(self):
        c = self.html[self.at] if self.at < len(self.html) else None
        self.at += 1
        return c

    def run(self):
        while (c := self.next()) is not None:
            if c == "<":
                self.tag_open()
        return self.tags

    def tag_open(self):
        c = self.next()
        if c == "!":
            self.declaration()
        elif c == "?":
            self.bogus()
        elif c == "/":
            c = self.next()
            if c is not None and is_letter(c):
                self.at -= 1
                self.tag(False)
            elif c is not None and c != ">":
                self.at -= 1
                self.bogus()
        elif c is not None and is_letter(c):
            self.at -= 1
            self.tag(True)
        else:
            self.at -= 1

    def bogus(self):
        while self.next() not in (">", None):
            pass

    def declaration(self):
        if not self.html.startswith("--", self.at):
            return self.bogus()
        self.at += 2
        state = "start"
        while (c := self.next()) is not None:
            if state in ("start", "start dash") and c == ">":
                return
            if state == "start":
                state = "start dash" if c == "-" else "comment"
            elif state == "start dash":
                state = "end" if c == "-" else "comment"
            elif state == "comment":
                state = "end dash" if c == "-" else "comment"
            elif state == "end dash":
                state = "end" if c == "-" else "comment"
            elif state == "end":
                if c == ">":
                    return
                state = {"!": "bang", "-": "end"}.get(c, "comment")
            elif state == "bang":
                if c == ">":
                    return
                state = "end dash" if c == "-" else "comment"

    def tag(self, opening):
        name = ""
        while (c := self.next()) is not None and c not in SPACES + "/>":
            name += low(c)
        attributes = {}
        while True:
            while c is not None and c in SPACES + "/":
                c = self.next()
            if c is None:
                return
            if c == ">":
                break
            key, c = low(c), self.next()
            while c is not None and c not in SPACES + "/>=":
                key, c = key + low(c), self.next()
            while c is not None and c in SPACES:
                c = self.next()
            value = ""
            if c == "=":
                c = self.next()
                while c is not None and c in SPACES:
                    c = self.next()
                if c is not None and c in "\"'":
                    quote, c = c, self.next()
                    while c is not None and c != quote:
                        value, c = value + c, self.next()
                    if c is None:
                        return
                    c = self.next()
                else:
                    while c is not None and c not in SPACES + ">":
                        value, c = value + c, self.next()
            attributes.setdefault(key, value)
        if not opening:
            return
        self.tags.append((name, attributes))
        if name == "plaintext":
            self.at = len(self.html)
        elif name in TEXT:
            self.text(name)

    def ends(self, name, mark="</"):
        """Does a tag of this name stand here?"""
        word = mark + name
        past = self.at + len(word)
        return low(self.html[self.at : past]) == word and self.html[past : past + 1] in tuple(SPACES + "/>")

    def text(self, name):
        state = "text"
        while self.at < len(self.html):
            if state != "double" and self.ends(name):
                return
            if name == "script":
                if state == "text" and self.html.startswith("<!--", self.at):
                    state = "escaped"
                    self.at += 2
                    continue
                if state != "text" and self.html.startswith("-->", self.at):
                    state = "text"
                elif state == "escaped" and self.ends(name, "<"):
                    state = "double"
                elif state == "double" and self.ends(name):
                    state = "escaped"
                    self.at += 2
            self.at += 1


def tags(html, name):
    return [attributes for found, attributes in Machine(html).run() if found == name]
