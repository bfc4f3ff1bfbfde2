"""The phrases of the contract and the public wordings of licenses, marked up for what may vary."""

#: Label by phrase.
PHRASES = {"GNU General Public License": "gpl", "Apache License": "apache", "CC BY": "cc-by", "MIT License": "mit"}

_OPENING = '<<beginOptional>><<var;name="subject";match="the|this|these|all">> <<var;name="kind";match=".{1,3}">> <<var;name="verb";match="is|are">><<endOptional>>'
_GIVEN = '<<var;name="given";match="licensed|released|distributed|available|published">> under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>>'
_HOLDER = '<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="copyright";match=".{0,20}">> <<beginOptional>>All rights reserved.<<endOptional>><<endOptional>>'

_MIT = f"""
<<beginOptional>>The MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>> {_HOLDER}
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="holders";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{{1,20}}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC = f"""
<<beginOptional>>ISC License<<endOptional>> {_HOLDER}
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="disclaimer";original="THE AUTHOR";match=".{{1,12}}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name="holder";original="THE AUTHOR";match=".{{1,12}}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_START = f"""
{_HOLDER}
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
<<var;name="bullet1";match=".{{0,1}}">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
<<var;name="bullet2";match=".{{0,1}}">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
<<var;name="bullet3";match=".{0,1}">> Neither the name of <<var;name="organization";original="the copyright holder";match=".{1,20}">> nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY <<var;name="holder";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{1,20}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""

#: Marked-up wordings by label: whole licenses, the notices that licenses ask to be put into files, and one-line statements.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [_MIT, f"{_OPENING} {_GIVEN} MIT License"],
    "ISC": [_ISC],
    "BSD-2-Clause": [_BSD_START + _BSD_END],
    "BSD-3-Clause": [_BSD_START + _BSD_THIRD + _BSD_END],
    "Apache-2.0": [
        f"{_OPENING} {_GIVEN} Apache License, Version 2.0",
        """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        <<var;name="address";match=".{3,12}">> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.
        """,
    ],
    "GPL-3.0": [
        f"{_OPENING} {_GIVEN} GNU General Public License, version 3",
        """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        """,
    ],
    "GPL-2.0": [f"{_OPENING} {_GIVEN} GNU General Public License, version 2"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "CC-BY-4.0": [f"{_OPENING} {_GIVEN} CC BY 4.0", f"{_OPENING} {_GIVEN} Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [f"{_OPENING} {_GIVEN} CC BY-NC 4.0", f"{_OPENING} {_GIVEN} Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": [f"{_OPENING} {_GIVEN} CC BY-SA 4.0", f"{_OPENING} {_GIVEN} Creative Commons Attribution-ShareAlike 4.0 International License"],
}
