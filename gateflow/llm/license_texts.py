"""Licence wording that the scan looks for."""

# Identifiers of the SPDX licence list.
SPDX: dict[str, str] = {
    "mit": "MIT",
    "apache-2": "Apache-2.0",
    "bsd-2": "BSD-2-Clause",
    "bsd-3": "BSD-3-Clause",
    "isc": "ISC",
    "mpl-2": "MPL-2.0",
    "gpl-2": "GPL-2.0-only GPL-2.0-or-later",
    "gpl-3": "GPL-3.0-only GPL-3.0-or-later",
    "lgpl-2.1": "LGPL-2.1-only LGPL-2.1-or-later",
    "lgpl-3": "LGPL-3.0-only LGPL-3.0-or-later",
    "agpl-3": "AGPL-3.0-only AGPL-3.0-or-later",
    "cc-by": "CC-BY-4.0",
    "cc-by-sa": "CC-BY-SA-4.0",
    "cc-by-nd": "CC-BY-ND-4.0",
    "cc-by-nc": "CC-BY-NC-4.0",
    "cc-by-nc-sa": "CC-BY-NC-SA-4.0",
    "cc-by-nc-nd": "CC-BY-NC-ND-4.0",
}
# The parts of the two common BSD licences.
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:"""
_BSD_TWO = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Published licence wording, one template a line or block.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Released under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0"""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:"""),
    ("mit", "MIT License Copyright (c)"),
    ("mit", "The MIT License (MIT)"),
    ("mit", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd-2", f"{_BSD_HEAD} {_BSD_TWO} {_BSD_TAIL}"),
    ("bsd-3", f"{_BSD_HEAD} {_BSD_TWO} {_BSD_THIRD} {_BSD_TAIL}"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("apache-2", "Apache License Version 2.0, January 2004"),
    ("mpl-2", "Mozilla Public License Version 2.0"),
    ("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("lgpl-3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl-3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *((label, f"Licensed under {name} 4.0.") for label, name in (
        ("cc-by-nd", "CC BY-ND"), ("cc-by-nc-sa", "CC BY-NC-SA"), ("cc-by-nc-nd", "CC BY-NC-ND"))),
    *((label, text.format(tag)) for label, tags in SPDX.items() for tag in tags.split()
      for text in ("SPDX-License-Identifier: {}", "Licensed under the {}")),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."""),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    *((label, f"This work is licensed under a Creative Commons {name} {version} License.")
      for label, name in (("cc-by", "Attribution"), ("cc-by-sa", "Attribution-ShareAlike"),
                          ("cc-by-nd", "Attribution-NoDerivatives"), ("cc-by-nc", "Attribution-NonCommercial"),
                          ("cc-by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
                          ("cc-by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))
      for version in ("4.0 International", "3.0 Unported") if label not in ("cc-by", "cc-by-nc") or version[0] == "3"),
    *((label, f"This work is licensed under the GNU {name}General Public License, version {version}.")
      for label, name, version in (("gpl-2", "", "2"), ("lgpl-2.1", "Lesser ", "2.1"), ("lgpl-3", "Lesser ", "3"),
                                   ("agpl-3", "Affero ", "3"))),
    *((label, f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU
{name}General Public License as published by the Free Software Foundation, either version {version} of the License, or
(at your option) any later version.""")
      for label, name, version in (("gpl-2", "", "2"), ("lgpl-2.1", "Lesser ", "2.1"), ("lgpl-3", "Lesser ", "3"),
                                   ("agpl-3", "Affero ", "3"))),
]
# The name and version that tell a licence from its neighbours.  A
# span must hold those of its label that its template holds.
NEEDS: dict[str, list[str]] = {
    "mit": ["mit license", "the mit"],
    "apache-2": ["apache license version 2", "apache 2 0"],
    "bsd-2": ["bsd 2 clause"],
    "bsd-3": ["bsd 3 clause", "neither the name"],
    "isc": ["the isc", "identifier isc"],
    "mpl-2": ["mozilla public license v 2", "mozilla public license version 2", "mpl 2 0"],
    "cc-by": ["cc by 4 0", "attribution 4 0", "attribution 3 0"],
    "cc-by-sa": ["cc by sa 4 0", "attribution sharealike"],
    "cc-by-nd": ["cc by nd 4 0", "attribution noderivatives"],
    "cc-by-nc": ["cc by nc 4 0", "attribution noncommercial 4 0", "attribution noncommercial 3 0"],
    "cc-by-nc-sa": ["cc by nc sa 4 0", "attribution noncommercial sharealike"],
    "cc-by-nc-nd": ["cc by nc nd 4 0", "attribution noncommercial noderivatives"],
    "gpl-2": ["gpl 2 0", "gnu general public license", "version 2"],
    "gpl-3": ["gpl 3 0", "gnu general public license", "version 3"],
    "lgpl-2.1": ["lgpl 2 1", "gnu lesser general public license", "version 2 1"],
    "lgpl-3": ["lgpl 3 0", "gnu lesser general public license", "version 3"],
    "agpl-3": ["agpl 3 0", "gnu affero general public license", "version 3"],
}
# Phrases whose places are counted, and their labels.
PHRASES: list[tuple[str, str]] = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
